"""Exact top-k inner-product search by pivot-table elimination (operator 2).

Vectors become integers (``floor(64 * x)``).  ``PIVOTS`` vectors, spread by farthest-first choice over a bounded
sample (the ``SAMPLE`` vectors of least hash), are the pivots; every vector's distances to them are computed once.
For a query q and a candidate x the largest ``|d(q, p) - d(x, p)|`` over the pivots is a lower bound on
``d(q, x)``, so ``(|q|^2 + |x|^2 - bound^2) / 2`` is an upper bound on their inner product.

Candidates are written in blocks of at most about ``BLOCK`` of the same or neighbouring pivots' cells, queries likewise.
First each query is searched in the block it lies in, which gives a score that its k-th best can't fall below.
Then pairs of blocks are judged by their ranges of pivot distances alone, and a pair whose bound is below all its
queries' known scores is never shipped.  Of the others, a block of candidates
travels once for ``TILE`` blocks of queries and pairs are formed inside tasks.  In a pair, queries of one cell are evaluated together,
a slice of candidates in the order of their bounds at a time, in one matrix product; candidates whose bound is
below the k-th score that every query left has so far are passed over, and a query is done when no bound reaches
its own.  Each pair returns at most k rows a query, those from the known score up, and one more window keeps the k best.

Edge cases: a vector that is null, empty, or holds a null or non-finite component takes no part; shorter
vectors count as padded by zeros; equal scores go to the smaller vec_id, null last; the query's own row is
every row with its vec_id; repeated query rows are one query, repeated candidates are candidates each;
an empty table gives an empty result; extra columns are ignored.  Scores are exact while they fit 53 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

SCALE = 64
PIVOTS = 32
SAMPLE = 1024
BLOCK = 4096
QUERIES = 4096
TILE = 8
CHUNK = 512        # candidates evaluated at once
GROUP = 64         # queries evaluated at once
RESULT = "query long, query_id long, vec_id long, score long"


def integers(v: Column) -> Column:
    """``floor(64 * x)`` of each component, null if the vector takes no part."""
    d = v.cast("array<double>")
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(F.coalesce(~bad & (F.size(d) > 0), F.lit(False)), F.transform(d, lambda x: F.floor(SCALE * x)))


def pivots(vectors: DataFrame, dim: int) -> np.ndarray:
    """Farthest-first choice from a bounded sample; at most PIVOTS x dim."""
    sample = vectors.orderBy(F.xxhash64("v"), "vec_id").limit(SAMPLE).select("v").collect()
    rows = np.zeros((len(sample), dim))
    for k, r in enumerate(sample):
        rows[k, :len(r.v)] = r.v
    chosen, gap = [], np.full(len(rows), np.inf)
    while len(chosen) < PIVOTS and len(rows) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


def _kinds(dim: int, most: int) -> tuple[str, type]:
    """(stored integer, number in which every inner product is exact)."""
    return "<i2" if most < 1 << 15 else "<i8", np.float32 if dim * most * most < 1 << 24 else np.float64


def _table(vectors: DataFrame, p: np.ndarray, stored: str) -> DataFrame:
    """``v`` and ``d`` (distances to the pivots, 32-bit) as bytes, ``n`` the squared norm and ``near`` the nearest pivot."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"), p.shape[1])
            n = (x ** 2).sum(1)
            d = np.sqrt(np.maximum(0, n[:, None] + (p ** 2).sum(1)[None] - 2 * x @ p.T))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), _bytes(x.astype(stored)), _bytes(d.astype("<f4")), pa.array(n), pa.array(d.argmin(axis=1), pa.int32())],
                ["vec_id", "v", "d", "n", "near"])

    return vectors.select("vec_id", "v").mapInArrow(measure, "vec_id long, v binary, d binary, n double, near int")


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    n, out = np.diff(lists.offsets.to_numpy()), np.zeros((len(lists), dim))
    out[np.arange(dim)[None] < n[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _bytes(x: np.ndarray) -> pa.Array:
    x = np.ascontiguousarray(x)
    at = pa.array(np.arange(len(x) + 1) * (x.shape[1] * x.itemsize), pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(x), [None, at.buffers()[1], pa.py_buffer(x)])


def _rows(rows: pa.Array, kind: str) -> np.ndarray:
    """Matrix from bytes of equal length."""
    return np.frombuffer(b"".join(rows.to_pylist()), kind).reshape(len(rows), -1)


def _upper(qn: np.ndarray, qd: np.ndarray, xn: np.ndarray, xd: np.ndarray) -> np.ndarray:
    """Upper bounds on the inner products; a matrix over queries and candidates."""
    lower = np.zeros((len(qd), xd.shape[1]), np.float32)
    gap = np.empty_like(lower)
    for p in range(qd.shape[1]):
        np.subtract(qd[:, p, None], xd[p][None], out=gap)
        np.abs(gap, out=gap)
        np.maximum(lower, gap, out=lower)
    # distances are 32-bit: the bound is loosened by far more than their error
    lower -= np.float32(1e-6) * (1 + max(float(qd.max(initial=0)), float(xd.max(initial=0))))
    lower = np.maximum(lower, 0).astype(np.float64)
    return np.floor((qn[:, None] + xn[None] - lower ** 2) / 2 * (1 + 1e-9) + 1e-6 * (1 + lower)) + 1


def evaluate(q, qd, floor, own, x, xd, ids, k, kind=np.float64) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(query, places, scores, evaluated) for each query against one block; ``ids`` decides ties.

    ``kind`` is a number in which every inner product is exact.
    """
    qn, xn = (q.astype(np.float64) ** 2).sum(1), (x.astype(np.float64) ** 2).sum(1)
    q, x, qd, xd = q.astype(kind), x.astype(kind), qd.astype(np.float32), np.ascontiguousarray(xd.T, np.float32)
    near = qd.argmin(1) if qd.shape[1] else np.zeros(len(q), np.int64)
    turn = np.argsort(near, kind="stable")
    edges = np.flatnonzero(np.diff(near[turn])) + 1
    for cell in np.split(turn, edges):             # queries of one cell share the order of their bounds
        for a in range(0, len(cell), GROUP):
            yield from _evaluate(cell[a:a + GROUP], q, qn, qd, floor, own, x, xn, xd, ids, k)


def _evaluate(who, q, qn, qd, floor, own, x, xn, xd, ids, k):
    upper = np.concatenate([_upper(qn[who], qd[who], xn[a:a + 1024], xd[:, a:a + 1024]) for a in range(0, len(x), 1024)], 1)
    upper[own[who, None] == ids[None]] = -np.inf
    least = floor[who].astype(np.float64)          # a candidate counts from this score up
    best = np.full((len(who), k), -np.inf)         # the k greatest scores so far
    found, done = [], np.zeros(len(who), np.int64)
    left = np.arange(len(x))
    base = np.where(np.isfinite(least), least, 0)
    left = left[np.argsort(-(upper - base[:, None]).max(0, initial=-np.inf), kind="stable")]
    active = np.arange(len(who))
    while len(left) and len(active):
        wanted = upper[np.ix_(active, left)] >= np.maximum(least[active, None], -np.finfo(np.float64).max)
        active, left = active[wanted.any(1)], left[wanted.any(0)]
        part, left = left[:CHUNK], left[CHUNK:]
        if not len(active):
            break
        scores = (q[who[active]] @ x[part].T).astype(np.float64)
        scores[upper[np.ix_(active, part)] == -np.inf] = -np.inf
        done[active] += len(part)
        i, j = np.nonzero(scores >= np.maximum(least[active, None], -np.finfo(np.float64).max))
        found.append((active[i], part[j], scores[i, j]))
        both = np.concatenate((best[active], scores), 1)
        best[active] = -np.partition(-both, k - 1, axis=1)[:, :k]
        least[active] = np.maximum(least[active], best[active].min(1))
    i, j, s = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    keep = s >= least[i]
    i, j, s = i[keep], j[keep], s[keep]
    order = np.lexsort((ids[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    at = np.searchsorted(i, np.arange(len(who) + 1))
    for n, w in enumerate(who.tolist()):
        b = min(at[n] + k, at[n + 1])
        yield w, j[at[n]:b], s[at[n]:b], int(done[n])


def _search(pairs: DataFrame, stored: str, kind: type, k: int) -> DataFrame:
    """Rows (q, x): a block of queries and a block of candidates."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(len(b)):
                qs, xs = b.column("q")[row].values, b.column("x")[row].values
                ids = xs.field("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                qid = qs.field("vec_id").to_numpy(zero_copy_only=False)
                number = qs.field("query").to_numpy(zero_copy_only=False)
                floor = qs.field("floor").cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                (q, qd), (x, xd) = [(_rows(s.field("v"), stored), _rows(s.field("d"), "<f4")) for s in (qs, xs)]
                found = list(evaluate(q, qd, floor, qid, x, xd, ids, k, kind))
                n = [len(p) for _, p, _, _ in found]
                who = np.repeat([i for i, _, _, _ in found], n).astype(np.int64)
                where = np.concatenate([p for _, p, _, _ in found]).astype(np.int64)
                score = np.concatenate([s for _, _, s, _ in found]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(number[who]), pa.array(qid[who]), xs.field("vec_id").take(pa.array(where)), pa.array(score)],
                                                 ["query", "query_id", "vec_id", "score"])

    return pairs.select("q", "x").mapInArrow(search, RESULT)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def _blocks(rows: DataFrame, size: int, key: Column) -> DataFrame:
    """Number each row's block: a large pivot cell is split at random, small ones share a block of about ``size``."""
    n = {r.near: r.n for r in rows.groupBy("near").agg(F.count("*").alias("n")).collect()}     # one row a pivot
    first, parts, at, room = {0: 0}, {0: 1}, -1, 0
    for p in sorted(n):
        parts[p] = -(-n[p] // size)
        if n[p] > room:                    # it begins a block, or several of its own
            first[p], at = at + 1, at + parts[p]
            room = size - n[p] if parts[p] == 1 else 0
        else:
            first[p], room = at, room - n[p]
    m, c = [F.create_map(*[F.lit(x) for p in of for x in (p, of[p])]) for of in (first, parts)]
    return rows.withColumn("block", (m[F.col("near")] + F.pmod(key, c[F.col("near")].cast("long"))).cast("int"))


def _ranges(blocks: DataFrame, of: str) -> DataFrame:
    """Per block, the least and greatest distance to each pivot and the greatest squared norm; one small row."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in range(len(b)):
                s = b.column(of)[row].values
                d = _rows(s.field("d"), "<f4").astype(np.float64)
                # no score is known for some query: nothing can be left out
                floor = min(s.field("floor").to_pylist(), key=lambda f: -np.inf if f is None else f) if of == "q" else None
                out.append((d.min(0).tolist(), d.max(0).tolist(), max(s.field("n").to_pylist()), floor))
            low, high, most, floor = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([b.column("block"), pa.array(low, pa.list_(pa.float64())), pa.array(high, pa.list_(pa.float64())),
                                              pa.array(most, pa.float64()), pa.array(floor, pa.int64())],
                                             ["block", "low", "high", "most", "floor"])

    return C.staged(blocks.select("block", of).mapInArrow(measure, "block int, low array<double>, high array<double>, most double, floor long"),
                    f"{of}-ranges")


def _pairs(q: DataFrame, x: DataFrame) -> DataFrame:
    """(qblock, block) of every pair whose bound reaches the least score known of its queries."""
    gap = F.zip_with("low", "qhigh", lambda a, b: a - b), F.zip_with("qlow", "high", lambda a, b: a - b)
    lower = F.greatest(F.array_max(gap[0]), F.array_max(gap[1]), F.lit(0.0))
    lower = F.greatest(F.coalesce(lower, F.lit(0.0)) - F.lit(1e-5) * (1 + F.array_max("high") + F.array_max("qhigh")), F.lit(0.0))
    tiles = x.agg(F.max(F.expr(f"block div {TILE}")).cast("int").alias("tiles")).first()[0]
    asked = q.select(F.col("block").alias("qblock"), F.col("low").alias("qlow"), F.col("high").alias("qhigh"), F.col("most").alias("qmost"),
                     F.col("floor"), F.explode(F.sequence(F.lit(0), F.lit(tiles))).alias("xtile"))
    met = asked.join(x.drop("floor").withColumn("xtile", F.expr(f"cast(block div {TILE} as int)")), "xtile")
    upper = (F.col("qmost") + F.col("most") - lower * lower) / 2 * F.lit(1 + 1e-9) + 2
    return met.filter(F.col("floor").isNull() | (upper >= F.col("floor"))).select(
        "qblock", "block", "xtile", F.expr(f"cast(qblock div {TILE} as int)").alias("qtile"))


def search(vectors: DataFrame, queries: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """The k best candidates of every row for which ``queries`` holds, against all rows: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    C.for_python(spark)
    valid = vectors.select("vec_id", integers(F.col(vector)).alias("v")).filter("v is not null")
    dim, most = valid.agg(F.max(F.size("v")), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    stored, kind = _kinds(dim, most)
    chosen = pivots(valid, dim)
    table = C.staged(_table(valid, chosen, stored), "pivot-table")
    hashed = F.xxhash64("vec_id", "v")
    # the row's number splits equal rows too; the table is written, so each row keeps its block
    rows = C.staged(_blocks(table, BLOCK, F.xxhash64("vec_id", "v", F.monotonically_increasing_id())), "candidates")
    members = F.collect_list(F.struct("vec_id", "v", "d", "n")).alias("x")          # about BLOCK rows, by the split above
    blocks = C.staged(rows.groupBy("block").agg(members), "candidate-blocks")
    asked = C.staged(rows.filter(F.coalesce(queries, F.lit(False))).dropDuplicates(["vec_id", "v"])
                     .select("vec_id", "v", "d", "n", "near", F.col("block").alias("home"), hashed.alias("query")), "queries")

    # a first score for each query, from the block it lies in
    begin = (asked.groupBy("home")
             .agg(F.collect_list(F.struct("vec_id", "v", "d", "query", F.lit(None).cast("long").alias("floor"))).alias("q"))
             .join(blocks, F.col("home") == F.col("block")))
    floor = _best(_search(begin, stored, kind, k), k).filter(F.col("rank") == k).select(F.col("query").alias("_q"), F.col("score").alias("floor"))
    known = C.staged(asked.join(floor, F.col("query") == F.col("_q"), "left").drop("_q"), "known")
    packed = C.staged(_blocks(known, QUERIES, F.col("query")).groupBy("block")
                      .agg(F.collect_list(F.struct("vec_id", "v", "d", "n", "query", "floor")).alias("q")), "query-blocks")
    pairs = C.staged(_pairs(_ranges(packed, "q"), _ranges(blocks, "x")), "block-pairs")

    # a candidate block travels once to each TILE query blocks it has a pair with; pairs are formed where it is
    left = (pairs.groupBy("qblock", "qtile", "xtile").agg(F.collect_list("block").alias("partners"))
            .join(packed.withColumnRenamed("block", "qblock"), "qblock"))
    right = pairs.select("block", "qtile", "xtile").distinct().join(blocks, "block")
    tiles = max(2, min(pairs.select("qtile", "xtile", F.pmod("block", F.lit(TILE))).distinct().count(), 4 * spark.sparkContext.defaultParallelism))
    slot = F.pmod("block", F.lit(TILE)).alias("slot")
    left = left.withColumn("slot", F.explode(F.array_distinct(F.transform("partners", lambda b: F.pmod(b, F.lit(TILE))))))
    met = (left.repartition(tiles, "qtile", "xtile", "slot")
           .join(right.select("*", slot).repartition(tiles, "qtile", "xtile", "slot").hint("shuffle_hash"), ["qtile", "xtile", "slot"])
           .filter(F.array_contains("partners", F.col("block"))))
    return _best(_search(met, stored, kind, k), k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM p QUALIFY rank <= 20
"""
