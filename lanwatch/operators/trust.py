"""Trusted-device table (T1–T4) as DataFrame operations.

The store is a table ``(mac, ip, label, added_at)`` keyed by normalised MAC;
``ip`` null means "any IP".  Updates are batches; a new snapshot is written
with overwrite semantics by the caller (``sources.state``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mac import normalize_mac

TRUST_SCHEMA = T.StructType([
    T.StructField("mac", T.StringType(), False),
    T.StructField("ip", T.StringType(), True),
    T.StructField("label", T.StringType(), True),
    T.StructField("added_at", T.StringType(), True),
])

PARTS = 16          # of the addresses of a MAC, in the join of events with the store


def empty_store(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TRUST_SCHEMA)


def upsert(store: DataFrame, updates: DataFrame, added_at: str | Column) -> DataFrame:
    """Add or update devices.

    ``updates``: ``mac``, optional ``ip``, ``label`` and ``seq`` (batch order).
    Several updates of one MAC in a batch collapse to the last non-null ip and
    the last non-empty label.  An existing device keeps its ``added_at``; ip
    is replaced only when given, label only when non-empty.
    """
    added_at = F.lit(added_at) if isinstance(added_at, str) else added_at
    u = updates.select(
        normalize_mac(F.col("mac")).alias("mac"),
        (F.col("ip") if "ip" in updates.columns else F.lit(None)).cast("string").alias("ip"),
        (F.col("label") if "label" in updates.columns else F.lit(None)).cast("string").alias("label"),
        (F.col("seq") if "seq" in updates.columns else F.monotonically_increasing_id()).alias("seq"),
    )
    u = u.groupBy("mac").agg(
        F.max_by("ip", F.when(F.col("ip").isNotNull(), F.col("seq"))).alias("u_ip"),
        F.max_by("label", F.when(F.coalesce(F.length("label"), F.lit(0)) > 0, F.col("seq"))).alias("u_label"),
    )
    s = store.select("mac", "ip", "label", "added_at")
    j = s.join(u, "mac", "full_outer")
    return j.select(
        "mac",
        F.coalesce("u_ip", "ip").alias("ip"),
        F.when(F.coalesce(F.length("u_label"), F.lit(0)) > 0, F.col("u_label"))
         .otherwise(F.coalesce(F.col("label"), F.lit(""))).alias("label"),
        F.coalesce(F.col("added_at"), added_at).alias("added_at"),
    )


def remove(store: DataFrame, macs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop devices by MAC; returns ``(remaining, removed)``."""
    keys = macs.select(normalize_mac(F.col("mac")).alias("mac")).distinct()
    return store.join(keys, "mac", "left_anti"), store.join(keys, "mac", "left_semi")


def get_device(store: DataFrame, mac: str) -> DataFrame:
    """One device (0 or 1 row)."""
    return store.where(F.col("mac") == normalize_mac(F.lit(mac)))


def list_devices(store: DataFrame) -> DataFrame:
    """T3."""
    return store.select("mac", "ip", "label", "added_at")


def trusted_flag(events: DataFrame, store: DataFrame, mac_col: str = "device_mac",
                 ip_col: str = "device_ip", out: str = "trusted") -> DataFrame:
    """T4: ``trusted`` = MAC in the store and (stored ip null, event ip null, or equal).

    A left join on the MAC and a part of the addresses: each device of the store is there once for each of
    ``PARTS`` parts, so that the events of a hot MAC are spread by their address.
    """
    dim = store.select(F.col("mac").alias("_t_mac"), F.col("ip").alias("_t_ip"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("_t_part"))
    part = F.pmod(F.xxhash64(F.col(ip_col)), F.lit(PARTS).cast("long"))
    j = events.join(dim, (normalize_mac(F.col(mac_col)) == F.col("_t_mac")) & (part == F.col("_t_part")), "left")
    ok = F.col("_t_mac").isNotNull() & (F.col("_t_ip").isNull() | F.col(ip_col).isNull()
                                         | (F.col("_t_ip") == F.col(ip_col)))
    return j.withColumn(out, ok).drop("_t_mac", "_t_ip", "_t_part")
