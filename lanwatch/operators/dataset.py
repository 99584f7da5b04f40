"""Dataset assembly and per-packet features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.timefmt import utc_hour, utc_minute, utc_second
from ..schema import BROADCAST_MAC, UNSPECIFIED_IP


# --------------------------------------------------------------------- N1, N2

def dataset_profile(packets: DataFrame) -> DataFrame:
    """Totals, per-operation counts, distinct senders, unspecified senders."""
    return packets.agg(
        F.count(F.lit(1)).alias("packets"),
        F.count_if(F.col("op") == 1).alias("requests"),
        F.count_if(F.col("op") == 2).alias("replies"),
        F.count_if(~F.coalesce(F.col("op").isin(1, 2), F.lit(False))).alias("other_ops"),
        F.count_distinct("src_ip").alias("distinct_src_ips"),
        F.count_distinct("src_mac").alias("distinct_src_macs"),
        F.count_if(F.col("src_ip") == UNSPECIFIED_IP).alias("unspecified_src"),
    )


def operation_counts(packets: DataFrame) -> DataFrame:
    """Packets per operation code."""
    return packets.groupBy("op").agg(F.count(F.lit(1)).alias("packets"))


def ip_mac_conflicts(packets: DataFrame) -> DataFrame:
    """Sender IPs (other than 0.0.0.0) seen with more than one sender MAC.

    Pairs are de-duplicated with a pre-aggregated group-by first, so the list
    built per IP holds its distinct MACs only (the output itself).
    """
    pairs = (packets.where(F.col("src_ip") != UNSPECIFIED_IP)
             .groupBy("src_ip", "src_mac").agg(F.count(F.lit(1)).alias("claims")))
    return (pairs.groupBy("src_ip")
            .agg(F.count(F.lit(1)).alias("n_macs"),
                 F.sum("claims").alias("packets"),
                 F.array_join(F.sort_array(F.collect_list("src_mac")), ",").alias("macs"))
            .where(F.col("n_macs") > 1))


# --------------------------------------------------------------------- N3–N6

def label_union(normal: DataFrame, attack: DataFrame, with_record_type: bool = False) -> DataFrame:
    """N3 (v1) / N4 (v2): label normal 0 and attack 1, then union by name."""
    n = normal.withColumn("label", F.lit(0))
    a = attack.withColumn("label", F.lit(1))
    if with_record_type:
        n = n.withColumn("record_type", F.lit("normal"))
        a = a.withColumn("record_type", F.lit("simulated_attack"))
    return n.unionByName(a, allowMissingColumns=True)


def seeded_shuffle(df: DataFrame, key_cols, seed: int = 42) -> DataFrame:
    """Repeatable shuffle: total order on a seeded hash of the row key."""
    cols = [F.col(c) for c in ([key_cols] if isinstance(key_cols, str) else key_cols)]
    return df.orderBy(F.xxhash64(*cols, F.lit(seed)), *cols)


def class_distribution(df: DataFrame, column: str = "label") -> DataFrame:
    """Value counts, most frequent first."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(column)))


# --------------------------------------------------------------------- N7

def _dense_index(df: DataFrame, order_col, name: str) -> DataFrame:
    """Attach a dense 0-based index in the order of ``order_col`` (one column or several), distributed, JVM only.

    The sorted frame is checkpointed (its partitioning is then fixed); each
    row's index is the row count of all earlier partitions (a prefix sum over
    one row per partition) plus its position inside its partition, read from
    ``monotonically_increasing_id`` (partition id in the upper 31 bits).
    """

    from ..session import materialize
    srt = materialize(df.orderBy(*([order_col] if isinstance(order_col, str) else order_col)).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned(F.col("_mid"), 33)
    counts = srt.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))).drop("_n")
    idx = F.col("_off") + (F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
    return (srt.withColumn("_pid", part).join(F.broadcast(offsets), "_pid")
            .withColumn(name, idx).drop("_pid", "_off", "_mid"))


def inject_anomalies(records: DataFrame, n: int = 4000, seed: int = 42,
                     key: str = "seq") -> DataFrame:
    """``n`` labelled spoof rows.

    Draw ``i`` picks a source row uniformly with replacement and replaces its sender MAC by another one
    of the data, sets the operation to reply and labels it 1.  The draws' row numbers are ranked
    among themselves; rank ``k`` stands for the row with the ``k``-th smallest seeded hash, so only the ``n`` rows
    (and ``n + 1`` MACs) of least hash are kept, by a bounded top-n in every partition; nothing else is sorted.
    """
    spark = records.sparkSession
    n_rows = records.count()
    senders = records.select("src_mac").where(F.col("src_mac").isNotNull()).distinct()
    n_macs = senders.count()
    if n_rows == 0 or n_macs < 2:
        raise ValueError("need at least one record and two distinct sender MACs")
    number = lambda cols: F.row_number().over(Window.orderBy(*cols)) - 1  # noqa: E731  over at most n + 1 rows
    pool = (records.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed), F.lit("row"))).orderBy("_h", key).limit(n)
            .withColumn("_row", number(["_h", key])).drop("_h"))
    macs = (senders.withColumn("_h", F.xxhash64("src_mac", F.lit(seed), F.lit("mac"))).orderBy("_h", "src_mac").limit(n + 1)
            .select(F.col("src_mac").alias("_spoof"), number(["_h", "src_mac"]).alias("_mac")))
    kept_macs = min(n + 1, n_macs)
    draws = spark.range(n).select(
        F.col("id").alias("draw"),
        F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit("row")), F.lit(n_rows)).alias("_at"),
        F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit("mac")), F.lit(kept_macs)).alias("_pick"))
    draws = draws.withColumn("_row", F.dense_rank().over(Window.orderBy("_at")) - 1)
    picked = draws.join(pool, "_row")
    # a draw that meets the row's own MAC takes the next one
    own = macs.select(F.col("_spoof").alias("_own"), F.col("_mac").alias("_own_at"))
    picked = picked.join(own, F.col("src_mac") == F.col("_own"), "left").withColumn(
        "_mac", F.when(F.col("_own_at") == F.col("_pick"), (F.col("_pick") + 1) % kept_macs).otherwise(F.col("_pick")))
    out = picked.join(macs, "_mac")
    return out.select(
        "draw", *[c for c in records.columns if c not in ("src_mac", "op")],
        F.col("_spoof").alias("src_mac"), F.lit(2).alias("op"),
        F.lit(1).alias("label"), F.lit("simulated_attack").alias("record_type"),
    )


# --------------------------------------------------------------------- N8–N14

def operation_code(op: Column) -> Column:
    """Request -> 0, reply -> 1, else null (canonical op 1/2 in)."""
    return F.when(op == 1, 0).when(op == 2, 1).otherwise(F.lit(None).cast("int"))


def is_unspecified_target(dst_ip: Column) -> Column:
    """N9."""
    return F.coalesce(dst_ip == UNSPECIFIED_IP, F.lit(False)).cast("int")


def is_broadcast_target(dst_mac: Column) -> Column:
    """N10."""
    return F.coalesce(F.lower(dst_mac) == BROADCAST_MAC, F.lit(False)).cast("int")


def packet_features(packets: DataFrame, keep=("seq",)) -> DataFrame:
    """Per-packet features; raw address and time columns dropped.

    ``macs_per_ip`` / ``sender_ip_frequency`` come from one per-IP aggregate
    joined back (DISTINCT is not allowed in a window).  The aggregate is
    pre-combined map-side; at run time AQE broadcasts it when it is small and
    splits a hot IP's partition when it is not.
    """
    per_ip = (packets.where(F.col("src_ip").isNotNull())
              .groupBy("src_ip").agg(F.count_distinct("src_mac").alias("macs_per_ip"),
                                     F.count(F.lit(1)).alias("sender_ip_frequency")))
    ts = F.col("ts_us")
    return packets.join(per_ip, "src_ip", "left").select(
        *keep,
        operation_code(F.col("op")).alias("operation"),
        is_unspecified_target(F.col("dst_ip")).alias("is_unspecified_target"),
        is_broadcast_target(F.col("dst_mac")).alias("is_broadcast_target"),
        "macs_per_ip", "sender_ip_frequency",
        utc_hour(ts).alias("hour"), utc_minute(ts).alias("minute"), utc_second(ts).alias("second"),
    )
