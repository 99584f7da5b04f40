"""Tumbling-window traffic features.

Windows are anchored at the first packet and half-open ``[start, start+w)``;
every window between the first and one past the last packet is emitted, empty
ones with all features 0.  The grid is ``ceil(span / w) + 1`` windows long.

Plan: one integer bin per packet, then a chain of pre-aggregated group-bys over one scan:
(bin, mac, ip) with (bin, target), then the distinct MACs and addresses of a bin, then the bin.  No ``collect_set``: a busy window never
builds an array, and every level is partially aggregated before its shuffle,
so a window that holds a third of all packets costs one row per
(mac, ip) pair in the shuffle, not one per packet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DEFAULT_WINDOW_SECONDS, MODEL_FEATURES, US, require_columns

WINDOW_COLUMNS = ["window_start"] + MODEL_FEATURES


class TooManyWindowsError(ValueError):
    pass


def time_bounds(packets: DataFrame) -> tuple[int | None, int | None, int]:
    """Min/max packet time and count (one fixed-size row to the driver)."""
    row = packets.agg(F.min("ts_us").alias("lo"), F.max("ts_us").alias("hi"),
                      F.count(F.lit(1)).alias("n")).first()
    return row["lo"], row["hi"], row["n"]


def window_count(lo: int, hi: int, w_us: int) -> int:
    span = hi - lo
    return span // w_us + 1 + (1 if span % w_us else 0)


def with_bin(packets: DataFrame, lo: int, w_us: int) -> DataFrame:
    return packets.withColumn("bin", F.expr(f"(ts_us - {int(lo)}) div {int(w_us)}"))


def _window_aggregates(binned: DataFrame) -> DataFrame:
    """Per non-empty bin: the ten features (no grid)."""
    # one scan: every packet brings its sender pair and its target address, told apart by ``kind``
    none = F.lit(None).cast("string")
    lvl1 = (binned.select("bin", "op", F.explode(F.array(
                F.struct(F.lit("sender").alias("kind"), F.col("src_mac").alias("mac"), F.col("src_ip").alias("ip")),
                F.struct(F.lit("target").alias("kind"), none.alias("mac"), F.col("dst_ip").alias("ip")))).alias("x"))
            .select("bin", "op", "x.*").where("kind = 'sender' OR ip IS NOT NULL")
            .groupBy("bin", "kind", "mac", "ip").agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("op") == 1).alias("n_req"),
                F.count_if(F.col("op") == 2).alias("n_rep")))
    # the distinct MACs (with their packets), sender IPs and target IPs of each window
    zero = F.lit(0).cast("long")
    lvl2 = (lvl1.select("bin", F.explode(F.when(F.col("kind") == "sender", F.array(
                F.struct(F.lit("mac").alias("kind"), F.col("mac").alias("key"), "n", "n_req", "n_rep", F.lit(1).cast("long").alias("pairs")),
                F.struct(F.lit("source").alias("kind"), F.col("ip").alias("key"), zero.alias("n"), zero.alias("n_req"),
                         zero.alias("n_rep"), zero.alias("pairs")))).otherwise(F.array(
                F.struct(F.lit("target").alias("kind"), F.col("ip").alias("key"), zero.alias("n"), zero.alias("n_req"),
                         zero.alias("n_rep"), zero.alias("pairs"))))).alias("x"))
            .select("bin", "x.*").groupBy("bin", "kind", "key")
            .agg(*[F.sum(c).alias(c) for c in ("n", "n_req", "n_rep", "pairs")]))
    lvl3 = lvl2.groupBy("bin").agg(
        F.sum("n").alias("total"),
        F.sum("n_req").alias("arp_request_count"),
        F.sum("n_rep").alias("arp_reply_count"),
        F.count_if(F.col("kind") == "mac").alias("unique_src_macs"),
        F.count_if(F.col("kind") == "source").alias("unique_src_ips"),
        F.count_if(F.col("kind") == "target").alias("unique_dst_ips"),
        F.sum("pairs").alias("ip_mac_pair_count"),
        F.max("n").alias("max_packets_per_mac"),
    )
    req = F.col("arp_request_count")
    rep = F.col("arp_reply_count")
    return (
        lvl3.select(
            "bin", "total", "arp_request_count", "arp_reply_count",
            F.round(rep / F.greatest(req, F.lit(1)), 6).alias("reply_request_ratio"),
            "unique_src_macs", "unique_src_ips",
            "unique_dst_ips", "ip_mac_pair_count", "max_packets_per_mac",
            (F.col("ip_mac_pair_count") - F.col("unique_src_macs")).alias("mac_ip_change_count"),
            F.round(F.greatest(rep - req, F.lit(0)) / F.greatest(F.col("total"), F.lit(1)), 6)
            .alias("unsolicited_reply_ratio"),
        )
    )


def engineer_features(packets: DataFrame, window_seconds: float = DEFAULT_WINDOW_SECONDS,
                      max_windows: int | None = None, include_bin: bool = False,
                      anchor: str = "first", bounds: tuple | None = None) -> DataFrame:
    """One row per window, ``window_start`` in epoch seconds (double).

    ``anchor="first"`` starts the grid at the first packet (documented
    behaviour); ``anchor="epoch"`` aligns it to multiples of the window, as
    streaming windows are.  ``bounds`` (``time_bounds`` of the packets) saves a scan if the caller has
    them.  ``max_windows`` (none by default) makes a longer grid an error.
    """
    require_columns(packets, ["ts_us", "op", "src_mac", "src_ip", "dst_ip"], "packets")
    spark: SparkSession = packets.sparkSession
    w_us = int(round(window_seconds * US))
    lo, hi, _ = bounds or time_bounds(packets)
    if lo is not None and anchor == "epoch":
        lo = lo - lo % w_us
    cols = (["bin"] if include_bin else []) + WINDOW_COLUMNS
    if lo is None:
        empty = spark.range(0).select(
            F.lit(0).cast("long").alias("bin"), F.lit(0.0).alias("window_start"),
            *[F.lit(0).cast("double" if c.endswith("ratio") else "long").alias(c) for c in MODEL_FEATURES])
        return empty.select(*cols)
    n = window_count(lo, hi, w_us)
    if max_windows is not None and n > max_windows:
        raise TooManyWindowsError(
            f"{n} windows of {window_seconds}s between {lo} and {hi}; raise max_windows if intended")
    feats = _window_aggregates(with_bin(packets.select("ts_us", "op", "src_mac", "src_ip", "dst_ip"), lo, w_us))
    grid = spark.range(0, n, numPartitions=max(1, min(n // 100_000 + 1, 4096))).withColumnRenamed("id", "bin")
    out = grid.join(feats, "bin", "left").select(
        "bin",
        ((F.lit(lo) + F.col("bin") * F.lit(w_us)).cast("double") / F.lit(1e6)).alias("window_start"),
        *[F.coalesce(F.col(c), F.lit(0).cast("double" if c.endswith("ratio") else "long")).alias(c)
          for c in MODEL_FEATURES],
    )
    return out.select(*cols)


def feature_summary(features: DataFrame, columns=None) -> DataFrame:
    """Mean, sample std, min, max per feature, one row per feature."""
    columns = columns or MODEL_FEATURES
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = features.agg(*aggs)
    stack = ", ".join(
        f"'{c}', `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {stack}) AS (feature, mean, std, min, max)")


def time_range(packets: DataFrame) -> DataFrame:
    """Packet count, first/last time and duration in seconds."""
    return packets.agg(
        F.count(F.lit(1)).alias("packets"),
        (F.min("ts_us") / F.lit(1e6)).alias("first_ts"),
        (F.max("ts_us") / F.lit(1e6)).alias("last_ts"),
        ((F.max("ts_us") - F.min("ts_us")) / F.lit(1e6)).alias("duration_s"),
    )
