"""Removal of repeated 400-byte strings by merged Burrows-Wheeler orders (operator 8).

A byte goes if a ``LENGTH``-byte string that covers it also starts anywhere else in the corpus.

Suffix orders of a whole corpus cannot be merged symbol by symbol within the limits (400 rounds over
every byte), so the merge runs on aligned pieces, where it is exact and bounded:

1. Anchors.  Every string of LENGTH bytes belongs to one anchor: of the 16-byte grams that start in its
   first half, the least by hash, the last of equal ones.  This depends on the string alone, so
   equal strings have equal anchors at equal offsets.  Strings in a row with one anchor are one
   context; its core is the half LENGTH from the anchor on, which all of them hold.
2. Counts by hash, pre-aggregated: a context whose core occurs once has no repeated string; contexts that
   occur whole, twice or more, are repeated whole.  What is left is one context for each distinct
   content, where another content shares its core.
3. Merge.  The contexts of one core are the rows of a positional Burrows-Wheeler transform.  They start as one
   interleave of the shards' rows; each column refines it by a stable partition by the byte there, so
   rows stay ordered by what precedes the column, and the common length of neighbours (the
   divergence array) follows from range maxima; no suffix is sorted again.  Neighbours that agree in LENGTH columns
   are a repeated interval.  All cores of a bucket go through the columns together, as arrays.
4. A core with more than ``LIMIT`` distinct contexts, which would fill one task, counts its strings by a
   128-bit hash in a distributed aggregation instead; nothing is dropped.
5. The repeated intervals return to their texts; each text is cut and hashed.

Texts are written once with row numbers; later passes read that table and a side table kept in one folder
for each of its parts, so texts are never shuffled.  Keys are 64-bit hashes of cores and contexts.

Edge cases: null text counts as empty; texts under LENGTH bytes keep all; repeated rows repeat each
other's strings; null doc_id is carried; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .flatfiles import _files
from .memory import give_back

LENGTH = 400
HALF = LENGTH // 2
GRAM = 16
LIMIT = 4096
PART_BITS = 33          # a row number is part << 33 | place, as monotonically_increasing_id gives it
FAR = 1 << 30
FLUSH = 4096            # rows that a pass gathers before it hands them on

CONTEXT = "core long, content long, row long, lo int, left int, n int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def contexts(raw: bytes) -> list[tuple[int, int, int, int, int]]:
    """(core, content, lo, left, n): strings ``lo`` to ``lo + n - 1`` share the anchor at ``lo + left``."""
    if len(raw) < LENGTH:
        return []
    h, size = _mixed(np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    grams = None
    while 2 * size <= HALF:               # hashes of 2, 4, ... bytes at every place
        h, size = _mixed(h[:-size] * np.uint64(0xBF58476D1CE4E5B9) + h[size:]), 2 * size
        if size == GRAM:
            grams = h
    place = np.arange(len(grams), dtype=np.uint64)
    low = (grams >> np.uint64(32) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - place)
    width = 1
    while 2 * width <= HALF + 1:          # least of each HALF + 1 grams in a row
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    low = np.minimum(low[:len(low) - (HALF + 1 - width)], low[HALF + 1 - width:])
    anchor = (np.uint64(0xFFFFFFFF) - (low[:len(raw) - LENGTH + 1] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    lo = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
    n = np.diff(np.append(lo, len(anchor)))
    at = anchor[lo]
    core = _mixed(h[at] * np.uint64(0xD6E8FEB86659FD93) + h[at + HALF - size]).view(np.int64)
    content = [xxhash.xxh3_64_intdigest(raw[a:a + k + LENGTH - 1]) for a, k in zip(lo.tolist(), n.tolist(), strict=True)]
    return list(zip(core.tolist(), np.array(content, np.uint64).view(np.int64).tolist(), lo.tolist(), (at - lo).tolist(), n.tolist(), strict=True))


def merged_intervals(core: np.ndarray, left: np.ndarray, n: np.ndarray, content: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each context the parts (start, end) that lie in a string which another context of its core holds too."""
    width = HALF + LENGTH
    begin, end = HALF - left, HALF - left + n + LENGTH - 1
    cells = np.zeros((len(core), width), np.uint8)
    for i, c in enumerate(content):
        cells[i, begin[i]:end[i]] = np.frombuffer(c, np.uint8)
    columns = np.ascontiguousarray(cells.T)
    order = np.argsort(core, kind="stable")                # the first interleave: all rows of a core, as they came
    group = np.unique(core, return_inverse=True)[1].astype(np.int64)[order]
    new_group = np.concatenate(([True], group[1:] != group[:-1]))
    since = np.where(new_group, FAR, 0)                     # column from which a row agrees with the one before it
    hit = np.zeros((len(core), HALF + 1), bool)
    for k in range(width):
        if not HALF <= k < LENGTH:                          # the core's columns are equal within a group
            symbol = columns[k][order].astype(np.int64)
            symbol[(k < begin[order]) | (k >= end[order])] = 256
            key = group * 257 + symbol
            if (key[1:] != key[:-1])[~new_group[1:]].any() or (symbol == 256).any():
                place = np.argsort(key, kind="stable")
                before, here = place[:-1], place[1:]
                apart = np.full(len(core), k + 1)
                same = (key[before] == key[here]) & (symbol[here] != 256)
                next_to = same & (here == before + 1)
                apart[1:][next_to] = since[here[next_to]]
                if (wide := same & ~next_to).any():         # largest value between the two rows' old places
                    edges = np.column_stack((before[wide] + 1, here[wide] + 1)).ravel()
                    apart[1:][wide] = np.maximum.reduceat(np.append(since, 0), edges)[::2]
                order, since = order[place], np.where(new_group, FAR, apart)   # groups keep their places
        if (c := k - LENGTH + 1) >= 0:
            near = since <= c
            near[:-1] |= since[1:] <= c
            rows = order[near]
            hit[rows, c] = (begin[rows] <= c) & (c + LENGTH <= end[rows])
    return [_covered(np.flatnonzero(h) - b) for h, b in zip(hit, begin, strict=True)]


def _covered(starts: np.ndarray) -> list[tuple[int, int]]:
    """Parts covered by the strings at these starts; starts in a row make one part."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    first, last = np.append(starts[:1], starts[cut + 1]), np.append(starts[cut], starts[-1:])
    return [(int(a), int(b) + LENGTH) for a, b in zip(first, last, strict=True)]


# ---- passes over the texts -------------------------------------------------------------------

@lru_cache(maxsize=1)
def _side(folder: str, part: int) -> tuple[np.ndarray, pa.Table | None]:
    """The side table's rows for one part of the texts, in order of row number, and these numbers."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    store, path = _files(f"{folder}/part={part}")
    tables = []
    if store.get_file_info(path).type != fs.FileType.NotFound:
        for f in store.get_file_info(fs.FileSelector(path)):
            if f.path.endswith(".parquet"):
                with store.open_input_file(f.path) as file:
                    tables.append(pq.read_table(file))
    if not tables:
        return np.zeros(0, np.int64), None
    t = pa.concat_tables(tables).sort_by("row").combine_chunks()
    return t.column("row").to_numpy(), t


def _beside(folder: str, row: int) -> list[dict]:
    """The side table's rows of one text."""
    rows, t = _side(folder, row >> PART_BITS)
    a, b = np.searchsorted(rows, [row, row + 1])
    return t.slice(a, b - a).to_pylist() if b > a else []


def _aside(df: DataFrame, name: str) -> str:
    """Write rows (row, ...) in one folder for each part of the texts."""
    folder = C.scratch_path(df.sparkSession, name)
    (df.withColumn("part", F.shiftright("row", PART_BITS)).repartition("part")
     .write.partitionBy("part").parquet(folder))
    return folder


def _encoded(texts: pa.Array) -> Iterator[bytes]:
    return (t.as_buffer().to_pybytes() for t in texts.cast(pa.large_binary()))


def _each(texts: DataFrame, make, schema: str) -> DataFrame:
    """Rows ``make(row, doc_id, raw)`` of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row, d, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _encoded(b.column(2)), strict=True):
                out.extend(make(row, d, raw))
                if len(out) >= FLUSH:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)
            b = out = raw = None
            give_back()

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    target = pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in schema.split(", "))])
    return texts.select("row", "doc_id", "text").mapInArrow(run, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def remove_repeats(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): bytes, removed bytes, removed runs, hash of the rest."""
    spark, limit = docs.sparkSession, LIMIT if limit is None else limit
    C.for_python(spark)
    texts = C.staged(docs.select("doc_id", C.text_of().alias("text")).withColumn("row", F.monotonically_increasing_id()), "texts")

    found = C.staged(_each(texts, lambda row, _, raw: [(c, u, row, lo, left, n) for c, u, lo, left, n in contexts(raw)], CONTEXT), "contexts")
    twice = found.groupBy("core").agg(F.count("*").alias("k")).filter("k > 1").drop("k")
    shared = C.staged(found.join(twice, "core", "left_semi"), "shared")
    distinct = C.staged(shared.groupBy("core", "content").agg(F.count("*").alias("k"), F.min(F.struct("row", "lo", "left", "n")).alias("x")), "distinct")
    whole = distinct.filter("k > 1").select("core", "content", F.array(F.struct(F.lit(0).alias("a"), (F.col("x.n") + LENGTH - 1).alias("b"))).alias("parts"))
    several = distinct.groupBy("core").agg(F.count("*").alias("m")).filter("m > 1")
    open_ = C.staged(distinct.join(several, "core").select("core", "content", "x.row", "x.lo", "x.left", "x.n", "m"), "open")

    few, many = open_.filter(F.col("m") <= limit), open_.filter(F.col("m") > limit)
    parts = whole.union(_merged(texts, few)).union(_counted(texts, many))
    spans = (shared.join(parts, ["core", "content"]).select("row", "lo", F.explode("parts").alias("p"))
             .groupBy("row").agg(F.array_sort(F.collect_set(F.struct((F.col("lo") + F.col("p.a")).alias("a"), (F.col("lo") + F.col("p.b")).alias("b")))).alias("spans")))
    folder = _aside(spans, "spans")

    def cut(row: int, doc_id, raw: bytes):
        kept, at, removed, runs = hashlib.sha256(), 0, 0, 0
        view, stop = memoryview(raw), -1
        for s in (x for r in _beside(folder, row) for x in r["spans"]):
            if s["a"] > stop:
                kept.update(view[at:s["a"]])
                runs += 1
            removed += max(0, s["b"] - max(s["a"], stop))
            at = stop = max(stop, s["b"])
        kept.update(view[at:])
        return [(doc_id, len(raw), removed, runs, kept.hexdigest())]

    return _each(texts, cut, RESULT)


def _merged(texts: DataFrame, contexts_: DataFrame) -> DataFrame:
    """(core, content, parts) by the merge; a core's contexts are in one bucket of about LIMIT rows."""
    folder, buckets = _aside(contexts_, "merge"), max(1, -(-contexts_.count() // LIMIT))

    def ship(row: int, _, raw: bytes):
        return [(r["core"], r["content"], r["left"], r["n"], raw[r["lo"]:r["lo"] + r["n"] + LENGTH - 1]) for r in _beside(folder, row)]

    def merge(t: pa.Table) -> pa.Table:
        core, left, n = [t.column(c).to_numpy().astype(np.int64) for c in ("core", "left", "n")]
        got = merged_intervals(core, left, n, t.column("bytes").to_pylist())
        keep = [i for i, g in enumerate(got) if g]
        return pa.table({"core": core[keep], "content": t.column("content").take(pa.array(keep, pa.int64())),
                         "parts": pa.array([[{"a": a, "b": b} for a, b in got[i]] for i in keep], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))})

    shipped = _each(texts, ship, "core long, content long, left int, n int, bytes binary")
    return (shipped.withColumn("bucket", F.pmod(F.xxhash64("core"), F.lit(buckets)))
            .groupBy("bucket").applyInArrow(merge, "core long, content long, parts array<struct<a:int,b:int>>"))


def _counted(texts: DataFrame, contexts_: DataFrame) -> DataFrame:
    """(core, content, parts) of cores with very many contexts: their strings are counted by a 128-bit hash."""
    folder = _aside(contexts_, "count")

    def strings(row: int, _, raw: bytes):
        for r in _beside(folder, row):
            for c in range(r["n"]):
                d = xxhash.xxh3_128_digest(raw[r["lo"] + c:r["lo"] + c + LENGTH])
                yield r["core"], r["content"], c, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)

    each = C.staged(_each(texts, strings, "core long, content long, c int, h1 long, h2 long"), "strings")
    twice = each.groupBy("h1", "h2").agg(F.count("*").alias("k")).filter("k > 1").drop("k")
    starts = (each.join(twice, ["h1", "h2"], "left_semi").groupBy("core", "content").agg(F.array_sort(F.collect_list("c")).alias("s")))   # at most HALF + 1 starts
    edge = lambda step: F.filter("s", lambda x: ~F.array_contains("s", x + step))
    return starts.select("core", "content", F.zip_with(edge(-1), edge(1), lambda a, b: F.struct(a.alias("a"), (b + LENGTH).alias("b"))).alias("parts"))
