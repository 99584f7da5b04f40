"""Interval join: which intervals cover which points, by equality only.

Positions are whole numbers from 0 inside a group (a key and a time bucket).  An interval ``[from, to)`` is cut
into aligned blocks of ``RADIX ** level`` positions, at most ``2 * (RADIX - 1)`` a level, so that each position lies
in exactly one block.  A point looks up the one block of each level that holds it.  The join is therefore an
equi-join on (group, level, block): it emits covering pairs only, never all pairs of a group, and a hot group is
spread over its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RADIX_BITS = 2
RADIX = 1 << RADIX_BITS


def _span(lo: Column, hi: Column) -> Column:
    """Whole numbers lo .. hi - 1, empty if lo >= hi."""
    return F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<bigint>"))


def _levels(length: str) -> Column:
    """Levels whose blocks are not longer than ``length``."""
    return F.expr(f"sequence(0, cast(floor(log2(greatest({length}, 1)) / {RADIX_BITS}) as int))")


def blocks_of(intervals: DataFrame) -> DataFrame:
    """Intervals (``_from``, ``_to``) to one row per block, ``_level`` and ``_block``."""
    x = intervals.withColumn("_level", F.explode(_levels("_to - _from")))
    size, up = f"shiftleft(1L, {RADIX_BITS} * _level)", f"shiftleft(1L, {RADIX_BITS} * _level + {RADIX_BITS})"
    lo, hi = F.expr(f"(_from + {size} - 1) div {size}"), F.expr(f"_to div {size}")
    # what whole blocks of the next level take
    lo_up, hi_up = F.expr(f"((_from + {up} - 1) div {up}) * {RADIX}"), F.expr(f"(_to div {up}) * {RADIX}")
    inner = F.when(lo_up < hi_up, F.concat(_span(lo, lo_up), _span(hi_up, hi))).otherwise(_span(lo, hi))
    return x.withColumn("_block", F.explode(inner)).drop("_from", "_to")


def covering(points: DataFrame, intervals: DataFrame, group: list[str], item: Column,
             smallest: int | None = None) -> DataFrame:
    """Points with ``_items``, the sorted items of all intervals that cover them.

    ``points`` has the group columns, ``_pos``, ``_size`` (a bound of the positions of the group) and a payload;
    ``intervals`` has the group columns, ``_from`` and ``_to``; ``item`` is built from the latter's columns.
    Group columns may be null.  A point that no interval covers is left out.  With ``smallest`` only that many
    smallest items are kept, in each block before the join, so that no list grows with the group; items must then
    differ between intervals that share a position.
    """
    blocks = blocks_of(intervals.select(*group, "_from", "_to", item.alias("_item")))
    place = [*group, "_level", "_block"]
    if smallest is not None:
        nth = F.row_number().over(Window.partitionBy(*place).orderBy("_item"))
        blocks = blocks.withColumn("_nth", nth).where(F.col("_nth") <= smallest).drop("_nth")
    lists = blocks.groupBy(*place).agg(F.collect_list("_item").alias("_list"))
    payload = [c for c in points.columns if c not in group and c not in ("_pos", "_size")]
    asked = (points.withColumn("_row", F.struct(*payload))
             .select(*group, "_pos", "_row", F.explode(_levels("_size")).alias("_level"))
             .withColumn("_block", F.expr(f"_pos div shiftleft(1L, {RADIX_BITS} * _level)")))
    a, b = asked.alias("a"), lists.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group] + [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("_level", "_block")]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    met = a.join(b, condition).select(*[F.col(f"a.{c}").alias(c) for c in group], "_pos", "_row", "_list")
    items = F.array_sort(F.flatten(F.collect_list("_list")))
    out = met.groupBy(*group, "_pos").agg(F.first("_row").alias("_row"), items.alias("_items"))
    if smallest is not None:
        out = out.withColumn("_items", F.slice("_items", 1, smallest))
    return out.select(*group, *[F.col(f"_row.{c}").alias(c) for c in payload], "_items")
