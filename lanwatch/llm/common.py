"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

# fixed values: ASCII white space that separates words, and the alphabets of A-Z lower-casing
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(c: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(c), F.lit(""))


def words(c: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a non-null text."""
    return F.filter(F.split(c, SPACE_RUN), lambda w: w != F.lit(""))


def n_words(c: Column) -> Column:
    """Number of words of a non-null text: pieces of a split, less the empty ones at either end."""
    pieces = F.split(c, SPACE_RUN)
    return (F.size(pieces)
            - F.when(F.element_at(pieces, 1) == "", 1).otherwise(0)
            - F.when((F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1).otherwise(0)).cast("long")


def lower_az(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name on the shared storage; Hadoop deletes it when the application ends."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/lanwatch-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(hadoop).deleteOnExit(p)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the true size, so that a join
    against a small result is broadcast only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, most: str = "4m") -> Iterator[None]:
    """Jobs run inside hand Python at most about ``most`` of rows at once, besides a single larger row."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def for_python(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers."""
    ship_package(spark)


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """All columns in one struct ``_row`` plus the needed ones: extra columns of any name pass through.

    A needed column that the table lacks is read as null (text, lang, source) .
    """
    have = set(docs.columns)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c) for c in needed])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")
