"""Connected components of an edge table, by alternating star contraction.

Each round makes every node point at the smallest node it knows (large star on bigger neighbours, small
star on smaller ones).  A round is two aggregations and two joins over at most as many rows as there
are edges; a hub's rows are pre-aggregated and its join is one that Spark can split.  Rounds are cut by
a written table in the shared folder; only a row count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    ``edges`` has columns a, b of one ordered type.  Loops and repeated edges are allowed; no edges
    give an empty result.
    """
    e = (edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e, before = _round(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        e = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = (e.join(low, "u").select(F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
             .select("x.u", "x.v").filter("u <> v").distinct())
        e, now = _round(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _round(e: DataFrame) -> tuple[DataFrame, tuple]:
    e = C.staged(e, "edges")
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return e, (r[0], r[1])
