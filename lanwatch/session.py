"""Session helpers.

Library code never creates a session; it uses the one it is handed.  These
helpers exist for tests, the bench and scripts.
"""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every lanwatch job relies on.  Time zone is pinned because
# `hour()/minute()` and `date_format` are evaluated in the session zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lanwatch") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of this application.

    ``spark.checkpoint.dir`` (or a directory already set on the context) names a shared folder and is
    used as is.  Where it is unset, only a local session (driver and executors in one process) gets
    a scratch folder, deleted when it ends; on a cluster that would be a folder executors can't see, so it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="lanwatch-ckpt-")
        path = sc._jvm.org.apache.hadoop.fs.Path(f"file://{conf}")
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def checkpoint_root(spark: SparkSession) -> str:
    """Folder under which operators write intermediate tables (shared storage)."""
    return ensure_checkpoint_dir(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name on the shared storage; Hadoop deletes it when the application ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/lanwatch-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def materialize(df):
    """Cut lineage of a small intermediate that several later steps read.

    Reliable ``checkpoint()`` into the shared folder named by
    ``spark.checkpoint.dir`` (never a local checkpoint): computed once,
    re-read by every consumer, and it survives the loss of an executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lanwatch`` importable on executors (Python workers), once per application.

    A zip of the package is written to the shared checkpoint folder through Hadoop's file system, whatever
    storage that is, and registered with ``addPyFile`` (what ``--py-files`` does).
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    path = sc._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark), f"lanwatch-{sc.applicationId}.zip")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    out.write(data.getvalue())
    out.close()
    fs.deleteOnExit(path)
    sc.addPyFile(fs.makeQualified(path).toString())
    _SHIPPED.add(sc.applicationId)
