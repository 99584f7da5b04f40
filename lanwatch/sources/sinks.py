"""Sinks (S5–S7, S9, S10) and state tables.

Writers take a path on shared storage; nothing is written to a machine-local
folder by the library itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import MODEL_FEATURES


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header (datasets, features, scaled features, predictions)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def prediction_records(preds: DataFrame, features=None, model_type: str = "IsolationForest") -> DataFrame:
    """Nested prediction records; ``window_start`` 0 when absent, features
    missing from the input are left out of the map."""
    feats = [c for c in (features or MODEL_FEATURES) if c in preds.columns]
    ws = F.col("window_start").cast("double") if "window_start" in preds.columns else F.lit(0.0)
    return preds.select(
        ws.alias("window_start"),
        F.col("anomaly_prediction").cast("int").alias("anomaly_prediction"),
        F.col("anomaly_score").cast("double").alias("anomaly_score"),
        F.col("is_anomaly").cast("boolean").alias("is_anomaly"),
        F.lit(model_type).alias("model_type"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in feats]),
                          F.array(*[F.col(c).cast("double") for c in feats])).alias("features"),
    )


def write_prediction_json(preds: DataFrame, path: str, **kw) -> None:
    """JSON Lines, one record per window."""
    prediction_records(preds, **kw).write.mode("overwrite").json(path)


def detection_report(dets: DataFrame, generated_at: str) -> DataFrame:
    """The one-row report (total, timestamp, statistics); the alerts
    themselves are written with ``write_detections``."""
    by_sev = dets.groupBy("severity").agg(F.count(F.lit(1)).alias("n")) \
        .agg(F.map_from_entries(F.collect_list(F.struct("severity", "n"))).alias("by_severity"))
    by_evt = dets.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")) \
        .agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("by_event"))
    total = dets.agg(F.count(F.lit(1)).alias("total_alerts"))
    # three one-row frames: combined by a scalar subquery each, no join
    return total.select(
        "total_alerts", F.lit(generated_at).alias("timestamp"),
        F.struct(F.col("total_alerts").alias("total_detections"),
                 by_sev.select("by_severity").scalar().alias("by_severity"),
                 by_evt.select("by_event").scalar().alias("by_event")).alias("statistics"))


def write_detections(dets: DataFrame, path: str, mode: str = "append") -> None:
    dets.write.mode(mode).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON document of serialisable metrics (every column is)."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


# ----------------------------------------------------------------- S11

class StateCorruptError(RuntimeError):
    pass


def _path(spark: SparkSession, path: str):
    """(Hadoop file system, path)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the snapshots that were saved in full, in order."""
    fs, p = _path(spark, f"{path}/_commits")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p)) if fs.exists(p) else []


def load_state(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", version: int | None = None) -> DataFrame:
    """A state table, by its last committed snapshot (or the ``version`` asked for).

    A missing path is an empty table with ``schema``.  A path that exists but cannot be read raises (silently
    dropping a trust list would be unsafe).  A folder without commits is read as a plain table.
    """
    from ..operators.incidents import _exists
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    versions = committed_versions(spark, path)
    if version is not None and version not in versions:
        raise StateCorruptError(f"state table at {path} has no version {version}")
    if not versions and _exists(spark, f"{path}/_commits"):
        return spark.createDataFrame([], schema)
    if versions:
        path = f"{path}/version={versions[-1] if version is None else version}"
    try:
        reader = spark.read.schema(schema)
        if fmt == "json":
            reader = reader.option("mode", "FAILFAST")
        df = reader.format(fmt).load(path)
        df.limit(1).collect()
        return df
    except Exception as e:  # noqa: BLE001
        raise StateCorruptError(f"state table at {path} is unreadable: {e}") from e


def save_state(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 2) -> int:
    """Save a snapshot as a folder of its own, then commit it; returns its version.

    The commit is one small file that must not exist yet, so it is there or not, and of two writers of one version the
    second fails.  A save that dies before it leaves the last snapshot as it was; what it wrote is overwritten by the
    next save.  ``df`` may read the table that it replaces.  The last ``keep`` snapshots stay.
    """
    spark = df.sparkSession
    versions = committed_versions(spark, path)
    version = versions[-1] + 1 if versions else 0
    fs, commits = _path(spark, f"{path}/_commits")
    fs.mkdirs(commits)
    df.write.mode("overwrite").format(fmt).save(f"{path}/version={version}")
    fs.create(_path(spark, f"{path}/_commits/{version}")[1], False).close()
    for old in versions[:max(0, len(versions) + 1 - keep)]:
        # the commit goes first: no reader picks a folder that is about to go
        fs.delete(_path(spark, f"{path}/_commits/{old}")[1], False)
        fs.delete(_path(spark, f"{path}/version={old}")[1], True)
    return version


def append_commit(df: DataFrame, path: str, commit: str, fmt: str = "json") -> None:
    """Add rows to a log under a name of the caller's; the same name again replaces them, so a retry doubles nothing."""
    if not commit or any(c in commit for c in "/=\\"):
        raise ValueError("a commit name is a plain word")
    df.write.mode("overwrite").format(fmt).save(f"{path}/commit={commit}")
