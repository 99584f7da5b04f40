"""Mixing sources to target weights along a time-varying curriculum (operator 7).

Targets.  A document's size is its number of words.  Sources, by code point with null last, weigh 5, 2, 1
and so on; they share ``SHARE`` of all words by weight.  No target exceeds ``MAX_PASSES`` times its
source's words; the excess is shared again by weight among the others until none is above.  The table
of sources is worked on by one window over one row per source.

Taking.  A source is read in a fixed random order (an MD5 of doc_id, source and text, so reruns agree): whole
passes first, then as many words of a last pass as the target leaves, so that the document at its end is taken in
part and a source is less than a word off.  The running sum over a source, which may hold a third of all
rows, is a prefix sum in two levels: within the 4096 buckets of the order, and over the buckets' sums.  Repeated
rows have one key; they are dealt over ``SALTS`` groups that are counted before the sum, so no bucket holds them all.

Curriculum.  A source's weight at time t in [0, 1] is ``target * (1 + s * (2 t - 1))``: its slope ``s`` runs
from ``-SLOPE`` for the first source to ``SLOPE`` for the last, so that early sources fade out.  The integral
is the share of its words demanded by t, ``(1 - s) t + s t**2``; the root of that quadratic gives every
taken copy, by the words taken before its middle, its training position.  ``mix`` gives both copies' positions and
sorts by the first; ``ordered`` range-sorts the documents by it.  A table of documents holds whole texts, so ``ordered``
has a copy taken in part if at least half of it is taken.

Edge cases: null text has size 0 and takes 0 words; null source is a source; null doc_id is ordered like any
other; repeated rows have equal keys and take consecutive places, whichever row comes first; very long texts are
sized whole and taken like others; an empty table gives an empty result; extra columns are ignored (operator) or
carried (stage).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

# fixed values of the contract
WEIGHTS = (5, 2, 1)
SHARE_NUM, SHARE_DEN = 3, 2
MAX_PASSES = 2

SLOPE = 0.5
BUCKET_DIGITS = 3        # hexadecimal digits of the order key: 4096 buckets a source
SALT = "mix"
SALTS = 256              # groups of the rows of one key


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, slope) from (source, source_size); rows are few: one a source.

    Water-filling in closed form: sources are ordered by capacity per weight, ``MAX_PASSES * size / weight``;
    the first ones are full.  A source is full if its level is at most what is left per remaining
    weight when all before it are full.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    by_level = every.orderBy("level", "place")
    cap = F.col("source_size") * MAX_PASSES
    left = F.col("budget") - F.col("cap_before")
    t = (sizes
         .withColumn("place", F.row_number().over(by_name) - 1)
         .withColumn("sources", F.count("*").over(every))
         .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int")))
         .withColumn("budget", F.sum("source_size").over(every) * SHARE_NUM / SHARE_DEN)
         .withColumn("cap", cap.cast("double"))
         .withColumn("level", F.col("cap") / F.col("weight"))
         .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("weight_left", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("full", F.col("cap") * F.col("weight_left") <= F.col("weight") * left)
         # full sources come first; the others share what these leave
         .withColumn("cap_full", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0)))
         .withColumn("weight_rest", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every))
         .withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(
             (F.col("budget") - F.col("cap_full")) * F.col("weight") / F.col("weight_rest")))
         .withColumn("slope", F.when(F.col("sources") > 1, SLOPE * (2 * F.col("place") / (F.col("sources") - 1) - 1)).otherwise(0.0)))
    return t.select("source", "source_size", "target", "slope")


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_file`` and ``_at``, which tell its rows apart and stay the same when it is read again."""
    try:
        meta = docs.metadataColumn("_metadata")
        docs.select(meta["row_index"]).schema      # plain tables and some formats have none
    except AnalysisException:
        docs = C.staged(docs, "mix")
        meta = docs.metadataColumn("_metadata")
    return C.packed(docs, "doc_id", "text", "source").withColumns(
        {"_file": F.xxhash64(meta["file_path"]), "_at": meta["row_index"]})


def takes(placed: DataFrame) -> DataFrame:
    """One row per document of ``_placed``: size, source, target, words taken and the position of each copy.

    ``copies`` counts the copies of which half or more is taken.
    """
    order = F.concat(F.lit(SALT), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"),
                     F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-")), F.lit("\n"), C.text_of())
    rows = C.staged(placed.select(
        "_file", "_at", "doc_id", "source", C.n_words(C.text_of()).alias("size"), F.md5(order).alias("key"),
        F.pmod("_at", F.lit(SALTS)).alias("salt"))
        .withColumn("bucket", F.conv(F.substring("key", 1, BUCKET_DIGITS), 16, 10).cast("int")), "sizes")
    same = rows.groupBy("source", "bucket", "key", "salt").agg(F.sum("size").alias("words"))
    sums = same.groupBy("source", "bucket").agg(F.sum("words").alias("words"))
    upto = lambda w: F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("source", "bucket", upto(Window.partitionBy("source").orderBy("bucket")).alias("words_before"))
    goal = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
    plan = C.staged(starts.join(goal, starts.source.eqNullSafe(goal.source)).select(
        starts.source.alias("_source"), F.col("bucket").alias("_bucket"), "words_before", "source_size", "target", "slope"), "plan")
    at = (same.withColumn("inside", upto(Window.partitionBy("source", "bucket").orderBy("key", "salt")))
          .join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
          .select("key", "salt", (F.col("words_before") + F.col("inside")).alias("first"), "source_size", "target", "slope"))
    nth = F.row_number().over(Window.partitionBy("key", "salt").orderBy("_file", "_at")) - 1
    passes = F.least(F.lit(MAX_PASSES), F.floor(F.col("target") / F.col("source_size")))
    half = F.col("size") / 2
    return (rows.withColumn("nth", nth).join(at, ["key", "salt"])
            .withColumn("at", F.col("first") + F.col("nth") * F.col("size"))         # words of its source before it
            .withColumn("passes", F.when(F.col("source_size") > 0, passes).otherwise(0))
            .withColumn("extra", F.floor(F.col("target") - F.col("passes") * F.col("source_size") + 1e-6))
            # words of the last, partial pass
            .withColumn("part", F.when(F.col("passes") < MAX_PASSES, F.greatest(
                F.lit(0), F.least("size", F.col("extra") - F.col("at")))).otherwise(0))
            .withColumn("taken", (F.col("passes") * F.col("size") + F.col("part")).cast("long"))
            .withColumn("copies", F.when(F.col("size") > 0, F.col("passes") + (F.col("part") >= half).cast("int")).otherwise(0).cast("int"))
            .withColumn("positions", F.transform(
                F.when(F.col("taken") > 0, F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1))
                .otherwise(F.array().cast("array<int>")),
                lambda k: _position((k * F.col("source_size") + F.col("at")
                                     + F.when(k < F.col("passes"), half).otherwise(F.col("part") / 2)) / F.col("target")))))


def _position(share):
    """Time in [0, 1] at which ``share`` of the source's words has been asked for."""
    s, u = F.col("slope"), F.least(F.lit(1.0), share)
    # (1 - s) t + s t^2 = u; written so that it holds for s = 0 too
    return 2 * u / (1 - s + F.sqrt((1 - s) * (1 - s) + 4 * s * u))


def mix(docs: DataFrame) -> DataFrame:
    """Size, target and words taken of every row of ``docs``, whole copies and both copies' positions, by the first position."""
    return takes(_placed(docs.select("doc_id", "text", "source"))).select(
        "doc_id", "size", "source_size", "target", "taken", "copies",
        *[F.round(F.get("positions", F.lit(k)), 9).alias(name) for k, name in enumerate(("position", "position_2"))]
    ).orderBy("position", "doc_id", "source_size")       # the untaken share no position; ids spread them over ranges


def ordered(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them (``_row``), range-sorted by training position."""
    rows = _placed(docs)
    plan = C.staged(takes(rows).filter("copies > 0").select(
        "_file", "_at", F.explode(F.slice("positions", F.lit(1), F.col("copies"))).alias("position")), "positions")
    return (rows.select("_row", "_file", "_at").join(plan, ["_file", "_at"]).select("_row", "position")
            .repartitionByRange("position").sortWithinPartitions("position"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents in training order, each as often as the mix takes it."""
    return C.unpacked(ordered(docs))


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda v: v <> '')) AS size,
                  md5('{SALT}' || coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce('+' || source, '-') || chr(10) || coalesce(text, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place, count(*) OVER () AS k FROM s),
w AS (SELECT *, ([5, 2, 1])[place % 3 + 1] AS weight, 1.5 * sum(source_size) OVER () AS budget, 2.0 * source_size AS cap FROM n),
l AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
             sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM w),
f AS (SELECT *, cap * weight_left <= weight * (budget - cap_before) AS is_full FROM l),
g AS (SELECT *, coalesce(sum(cap) FILTER (is_full) OVER (), 0) AS cap_full, sum(weight) FILTER (NOT is_full) OVER () AS rest FROM f),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE (budget - cap_full) * weight / rest END::DOUBLE AS target,
             CASE WHEN k > 1 THEN {SLOPE} * (2.0 * place / (k - 1) - 1) ELSE 0 END::DOUBLE AS slope FROM g),
a AS (SELECT d.*, t.source_size, t.target, t.slope,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
             CASE WHEN t.source_size > 0 THEN least(2, floor(t.target / t.source_size)) ELSE 0 END AS passes
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CASE WHEN passes < 2 THEN greatest(0, least(size, floor(target - passes * source_size + 1e-6) - ahead)) ELSE 0 END AS part FROM a),
e AS (SELECT *, passes * size + part AS taken,
             CASE WHEN target > 0 THEN least(1.0, (ahead + CASE WHEN passes > 0 THEN size / 2.0 ELSE part / 2.0 END) / target) END AS u,
             CASE WHEN target > 0 THEN least(1.0, (source_size + ahead + CASE WHEN passes > 1 THEN size / 2.0 ELSE part / 2.0 END) / target) END AS v FROM c)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       CASE WHEN size = 0 THEN 0 ELSE passes + CASE WHEN part >= size / 2.0 THEN 1 ELSE 0 END END::INTEGER AS copies,
       CASE WHEN taken > 0 THEN round(2 * u / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * u)), 9) END AS position,
       CASE WHEN taken > size THEN round(2 * v / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * v)), 9) END AS position_2
FROM e
"""
