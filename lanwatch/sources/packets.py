"""Packet readers and adapters.

All readers return the canonical packet schema of ``lanwatch.schema``.  Text is
read as strings and converted with ``try_cast`` (ANSI mode would raise on a
bad value); rows that lose a required field are split off into a rejects
frame, so the dropped count is a query rather than a print.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import utc_parse_us, utc_text
from ..schema import CAPTURE_COLUMNS, ML_PACKET_COLUMNS, NA_TOKENS, ContractError, US

CANONICAL = ["seq", "ts_us", "op", "src_mac", "dst_mac", "src_ip", "dst_ip"]


def _na(c: str) -> Column:
    """pandas-style NA tokens -> null."""
    return F.when(F.col(c).isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(F.col(c))


def _string_schema(cols) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def _headers(spark: SparkSession, paths) -> dict[tuple[str, ...], list[str]]:
    """Header -> files that have it.  The first line of every file; one row a file comes to the driver."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"), "value").where("b = 0")
    out: dict[tuple[str, ...], list[str]] = {}
    for r in lines.groupBy("f").agg(F.min_by("value", "i").alias("h")).orderBy("f").collect():
        out.setdefault(tuple(next(csv.reader([r["h"]]))), []).append(r["f"])
    return out


def read_csv_by_name(spark: SparkSession, paths, required, what: str) -> DataFrame:
    """CSV files as text columns, bound by each file's own header, plus ``_file``, ``_block`` and ``_id``.

    Files whose headers differ in order or in further columns are read group by group and united by
    name; a file that lacks a required column raises.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    frames = []
    for header, files in _headers(spark, paths).items():
        missing = [c for c in required if c not in header]
        if missing:
            raise ContractError(f"{what} is missing required columns {missing}; found {list(header)} in {files[0]}")
        raw = spark.read.option("header", True).schema(_string_schema(header)).csv(files)
        frames.append(raw.select(*[F.col(f"`{c}`") for c in header], F.col("_metadata.file_path").alias("_file"),
                                 F.col("_metadata.file_block_start").alias("_block"),
                                 F.monotonically_increasing_id().alias("_id")))
    if not frames:
        return spark.createDataFrame([], _string_schema([*required, "_file"])).selectExpr("*", "0L AS _block", "0L AS _id")
    return union_frames(frames)


def with_seq(raw: DataFrame) -> DataFrame:
    """Number the rows by (file, place in the file), however the files were split.

    Each block of a file brings one row (its count and first id) into a prefix sum; a row's number is
    what lies before its block plus its place in it.
    """
    blocks = raw.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")) - F.col("_first")
    return (raw.join(blocks.withColumn("_start", start).drop("_n", "_first"), ["_file", "_block"])
            .withColumn("seq", F.col("_start") + F.col("_id")).drop("_start", "_block", "_id"))


def read_packet_csv(spark: SparkSession, paths, split_rejects: bool = False, keep=()):
    """ML-dialect CSV (timestamp epoch seconds, op 1/2) -> canonical packets.

    Returns the clean frame, or ``(clean, rejects)`` when ``split_rejects``.  ``seq`` numbers the rows
    by file and place in it.
    """
    raw = with_seq(read_csv_by_name(spark, paths, ML_PACKET_COLUMNS, "packet CSV")).drop("_file")
    return apply_packet_contract(raw, split_rejects, keep)


def apply_packet_contract(raw: DataFrame, split_rejects: bool = False, keep=()):
    """S1 on text columns: NA tokens -> null, numeric coercion, drop incomplete.

    ``raw`` holds the six ML-dialect columns as strings plus ``seq``.
    ``op`` is truncated to an integer, time becomes epoch microseconds.
    """
    missing = [c for c in ML_PACKET_COLUMNS + ["seq"] if c not in raw.columns]
    if missing:
        raise ContractError(f"packet records miss {missing}")
    typed = raw.select(
        "seq", *keep,
        F.expr("try_cast(timestamp AS DOUBLE)").alias("_t"),
        F.expr("try_cast(op AS DOUBLE)").alias("_op"),
        *[_na(c).alias(c) for c in ("src_mac", "dst_mac", "src_ip", "dst_ip")],
    )
    ok = (F.col("_t").isNotNull() & ~F.isnan("_t") & F.col("_op").isNotNull() & ~F.isnan("_op")
          & F.col("src_mac").isNotNull() & F.col("src_ip").isNotNull())
    clean = typed.where(ok).select(
        "seq", *keep,
        F.round(F.col("_t") * F.lit(US)).cast("long").alias("ts_us"),
        F.col("_op").cast("int").alias("op"),
        "src_mac", "dst_mac", "src_ip", "dst_ip",
    )
    if not split_rejects:
        return clean
    return clean, typed.where(~ok)


def capture_to_canonical(df: DataFrame) -> DataFrame:
    """Capture dialect (string time 'yyyy-MM-dd HH:mm:ss', request/reply) -> canonical."""
    missing = [c for c in CAPTURE_COLUMNS if c not in df.columns]
    if missing:
        raise ContractError(f"capture records miss {missing}")
    seq = F.col("seq") if "seq" in df.columns else F.monotonically_increasing_id()
    op = (F.when(F.col("operation") == "request", 1)
          .when(F.col("operation") == "reply", 2).otherwise(F.lit(None)).cast("int"))
    return df.select(
        seq.alias("seq"), utc_parse_us(F.col("timestamp")).alias("ts_us"), op.alias("op"),
        F.col("sender_mac").alias("src_mac"), F.col("target_mac").alias("dst_mac"),
        F.col("sender_ip").alias("src_ip"), F.col("target_ip").alias("dst_ip"),
        *[c for c in ("label", "record_type") if c in df.columns],
    )


def canonical_to_capture(packets: DataFrame, keep=()) -> DataFrame:
    """Canonical packets -> capture records (second-precision local time text).

    op 1 -> request, 2 -> reply, anything else -> unknown.
    """
    operation = (F.when(F.col("op") == 1, "request").when(F.col("op") == 2, "reply")
                 .otherwise("unknown"))
    return packets.select(
        *keep,
        utc_text(F.col("ts_us")).alias("timestamp"),
        F.col("src_ip").alias("sender_ip"), F.col("src_mac").alias("sender_mac"),
        F.col("dst_ip").alias("target_ip"), F.col("dst_mac").alias("target_mac"),
        operation.alias("operation"),
    )


def read_capture_csv(spark: SparkSession, paths, number: bool = False) -> DataFrame:
    """Capture files, columns by name; ``number`` adds ``seq``, the row's place in the ordered files."""
    raw = read_csv_by_name(spark, paths, CAPTURE_COLUMNS, "capture CSV")
    if number:
        raw = with_seq(raw)
    return raw.select(*(["seq"] if number else []), *[_na(c).alias(c) for c in CAPTURE_COLUMNS])


def read_sessions(spark: SparkSession, paths, fmt: str = "csv", columns=None) -> tuple[DataFrame, DataFrame]:
    """S3: read several capture sessions at once.

    Returns ``(records, per_file_counts)``; records are projected to
    ``columns`` (default: the six capture fields) and carry ``session_file``.
    One scan serves all files; the count is a group-by on the file name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    cols = columns or CAPTURE_COLUMNS
    if fmt == "csv":
        recs = (read_csv_by_name(spark, paths, cols, "session file")
                .select(*cols, F.element_at(F.split("_file", "/"), -1).alias("session_file")))
        return recs, recs.groupBy("session_file").agg(F.count(F.lit(1)).alias("records"))
    df = spark.read.format(fmt).load(paths)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ContractError(f"sessions miss columns {missing}")
    recs = df.select(*cols, F.col("_metadata.file_name").alias("session_file"))
    counts = recs.groupBy("session_file").agg(F.count(F.lit(1)).alias("records"))
    return recs, counts


def union_frames(frames) -> DataFrame:
    """Union by name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
