"""Exact interpolated quantiles by distributed rank, for any number of columns in one pass."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def column_quantiles(df: DataFrame, shares: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """For each column, the quantiles of its non-null values, linearly interpolated between ranks.

    Equal values of a column are counted, and the counts are range-sorted by (column, value) and written once.
    How many rows each (partition, column) holds, one small row each, tells the driver which of them hold a wanted
    rank; only those are numbered, inside their partition.  The jobs are the same whatever the columns, and no
    task holds more than a range.
    """
    names = list(shares)
    if not names:
        return {}
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(n).cast("double").alias("v")) for i, n in enumerate(names)])).alias("x")).select("x.*")
    counts = values.where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    ranged = materialize(counts.orderBy("c", "v").withColumn("part", F.spark_partition_id()))
    wanted, at, before = [], {}, {}
    parts = ranged.groupBy("c", "part").agg(F.sum("n").alias("size")).orderBy("c", "part").collect()
    total = {c: sum(r["size"] for r in parts if r["c"] == c) for c in range(len(names))}
    for c, name in enumerate(names):
        at[c] = [s * (total[c] - 1) for s in shares[name]] if total[c] else []
    for r in parts:
        c, start = r["c"], before.get(r["c"], 0)
        before[c] = start + r["size"]
        wanted += [(c, r["part"], k, k - start) for k in {f(h) for h in at[c] for f in (math.floor, math.ceil)} if start <= k < before[c]]
    found = {}
    if wanted:
        spark = df.sparkSession
        ranks = F.broadcast(spark.createDataFrame(wanted, "c int, part int, rank long, here long"))     # two rows a share
        upto = F.sum("n").over(Window.partitionBy("c", "part").orderBy("v"))
        held = ranged.join(F.broadcast(ranks.select("c", "part").distinct()), ["c", "part"]).withColumn("upto", upto)
        hit = held.join(ranks, ["c", "part"]).where((F.col("here") < F.col("upto")) & (F.col("here") >= F.col("upto") - F.col("n")))
        found = {(r["c"], r["rank"]): r["v"] for r in hit.select("c", "rank", "v").collect()}

    def between(c: int, h: float) -> float:
        low, high = found[c, math.floor(h)], found[c, math.ceil(h)]
        return low + (high - low) * (h - math.floor(h))

    return {n: [between(c, h) for h in at[c]] if total[c] else [None] * len(shares[n]) for c, n in enumerate(names)}


def exact_quantiles(df: DataFrame, column: str, shares) -> list[float | None]:
    """The quantiles of one column."""
    return column_quantiles(df, {column: list(shares)})[column]
