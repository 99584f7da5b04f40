"""Detection history: filters, statistics, routing, serialisation (H1–H6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import utc_text

# Which severities go to the console and the log.
CONSOLE_SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM"]
LOG_SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]

def _latest_first():
    return [F.desc("ts_us"), F.desc("seq"), F.desc("rule_no")]


def latest_detections(dets: DataFrame, n: int) -> DataFrame:
    """The ``n`` most recent detections (a top-k: Spark keeps k rows per task)."""
    return dets.orderBy(*_latest_first()).limit(n)


def filter_detections(dets: DataFrame, severity: str | None = None, event_type: str | None = None,
                      limit: int | None = None) -> DataFrame:
    """H1: by severity and/or event type; ``limit`` keeps the latest N (0/None: all)."""
    out = dets
    if severity:
        out = out.where(F.col("severity") == severity)
    if event_type:
        out = out.where(F.col("event_type") == event_type)
    if limit:
        out = latest_detections(out, limit)
    return out


def recent_detections(dets: DataFrame, as_of, window_s: int) -> DataFrame:
    """H2: detections newer than ``as_of - window_s``.

    ``as_of`` is epoch microseconds, or a one-row DataFrame with column
    ``as_of`` (used as a scalar subquery; no wall clock inside the job).
    """
    if isinstance(as_of, DataFrame):
        cutoff = as_of.select(F.max("as_of")).scalar() - F.lit(window_s * 1_000_000)
        return dets.where(F.col("ts_us") > cutoff)
    return dets.where(F.col("ts_us") > F.lit(int(as_of) - window_s * 1_000_000))


def detection_statistics(dets: DataFrame) -> DataFrame:
    """H3: total, counts by severity and by event type (long format), one pass
    with grouping sets."""
    g = dets.groupingSets([["severity"], ["event_type"], []], "severity", "event_type") \
        .agg(F.count(F.lit(1)).alias("detections"), F.grouping_id().alias("_gid"))
    return g.select(
        F.when(F.col("_gid") == 3, "total").when(F.col("_gid") == 1, "severity").otherwise("event_type")
        .alias("dimension"),
        F.when(F.col("_gid") == 3, "all").when(F.col("_gid") == 1, F.col("severity"))
        .otherwise(F.col("event_type")).alias("value"),
        "detections")


def alert_routing(dets: DataFrame) -> DataFrame:
    """H4: where each detection goes (console, log) and at which log level."""
    return dets.withColumns({
        "to_console": F.col("severity").isin(CONSOLE_SEVERITIES),
        "to_log": F.col("severity").isin(LOG_SEVERITIES),
        "log_level": F.when(F.col("severity") == "CRITICAL", "CRITICAL").otherwise("WARNING"),
    })


def detection_json(dets: DataFrame) -> DataFrame:
    """H5: one JSON document per detection (ISO time, packet omitted)."""
    iso = utc_text(F.col("ts_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    doc = F.struct(
        "detection_id", "event_type", "severity", "reason",
        F.struct(F.col("device_ip").alias("ip"), F.col("device_mac").alias("mac")).alias("affected_device"),
        iso.alias("timestamp"), F.col("info").alias("additional_info"))
    return dets.select("detection_id", F.to_json(doc).alias("json"))


def clear_history(dets: DataFrame) -> DataFrame:
    """H6: an empty detection table with the same schema (rule state untouched:
    state lives in the packet history / streaming checkpoint, not here)."""
    return dets.where(F.lit(False))
