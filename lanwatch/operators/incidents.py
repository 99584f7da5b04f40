"""Incident records (I1, I2, S8): built as a struct, appended as JSON Lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import INCIDENT_SOURCE, INCIDENT_TYPE
from ..sources.sinks import append_commit

RISK_TYPE = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("level", T.StringType()),
    T.StructField("rule_score", T.DoubleType()), T.StructField("ml_score", T.DoubleType()),
    T.StructField("rule_findings", T.ArrayType(T.StringType())),
    T.StructField("ml_anomaly", T.BooleanType()), T.StructField("explanation", T.StringType()),
])

INCIDENT_SCHEMA = T.StructType([
    T.StructField("incident_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("incident_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("details", T.StructType([
        T.StructField("device_mac", T.StringType()),
        T.StructField("device_ip", T.StringType()),
        T.StructField("trusted_device", T.BooleanType()),
        T.StructField("risk", RISK_TYPE),
    ])),
])


def build_incidents(assessed: DataFrame, created_at: str | Column, key_cols=("event_key",),
                    source: str = INCIDENT_SOURCE) -> DataFrame:
    """One incident per assessed event (type ARP_ANOMALY, severity = level).

    ``incident_id`` is a hash of the event key, so appending the same batch
    twice is detectable and re-runs are idempotent.
    """
    created = F.lit(created_at) if isinstance(created_at, str) else created_at
    return assessed.select(
        *[c for c in key_cols],
        F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols]), 256).alias("incident_id"),
        created.alias("timestamp"),
        F.lit(source).alias("source"),
        F.lit(INCIDENT_TYPE).alias("incident_type"),
        F.col("risk.level").alias("severity"),
        F.struct(F.col("device_mac"), F.col("device_ip"), F.col("trusted").alias("trusted_device"),
                 F.col("risk").cast(RISK_TYPE).alias("risk")).alias("details"),
    )


def append_incidents(incidents: DataFrame, path: str, commit: str | None = None) -> None:
    """Append-only JSON Lines log; with a ``commit`` name, the same call again replaces what it added before."""
    rows = incidents.select(*[f.name for f in INCIDENT_SCHEMA.fields])
    if commit is None:
        rows.write.mode("append").json(path)
    else:
        append_commit(rows, path, commit)


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    """Every record; a missing log is empty; a corrupt line fails the read."""
    if not _exists(spark, path):
        return spark.createDataFrame([], INCIDENT_SCHEMA)
    return spark.read.schema(INCIDENT_SCHEMA).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system that Hadoop resolves the path to; a bare path belongs to its default one."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
