"""All five rules over a stream, with whole detection records and a ledger of late rows.

A micro-batch joins what a few small tables know of the past and runs the batch rules on it, so a stream
row is the batch row in every column, one hot address is split by time like in batch, and no Python runs.

The state of batch ``b`` is one immutable folder, ``<path>/state/batch=<b>``, made only from the folder of
batch ``b - 1`` and the rows of ``b``:

* ``pending``: rows later than the clock (greatest time seen less ``delay``); they wait for rows still under way;
* ``recent``: rows up to the clock that a window can still see, and the last row of every address,
  however old, because rule 1 compares with it;
* ``changes``: mapping changes that a window can still see, and the last five of every address;
* ``addresses``: one row an address, packets and changes so far, which continue the batch rules' running numbers;
* ``clock``: one row.

Everything but the last row, the last changes and the counts of an address expires with the clock.  A retried batch
overwrites its own folders, so rows are neither lost nor doubled.  A row that arrives when the clock has passed its
time is late: it goes to ``<path>/late/batch=<b>`` and takes part in nothing else.

Nulls: a row without a time is kept in the ledger too; a null address is an address of its own (no rule fires on it).
Peers in time are ordered by ``seq``.  Empty batches write empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import rules as R

STATE_PARTS = ("pending", "recent", "changes", "addresses", "clock")
_PACKET = "seq long, ts_us long, op int, src_ip string, src_mac string, dst_ip string"
_CHANGE = "seq long, ts_us long, src_ip string, src_mac string, prev_ts_us long, prev_seq long, prev_src_mac string"
_SCHEMAS = {"pending": _PACKET, "recent": _PACKET, "changes": _CHANGE,
            "addresses": "src_ip string, packets long, changes long", "clock": "clock_us long"}
LATE = _PACKET + ", batch long"
KEPT_CHANGES = 5           # as many earlier changes as a record of rules 1 and 3 can list
START = -(1 << 62)         # the clock before the first row


def _state_path(path: str, batch: int) -> str:
    return f"{path}/state/batch={batch}"


def load_state(spark: SparkSession, path: str, batch: int) -> dict[str, DataFrame]:
    """State after a batch; before the first one, empty."""
    if batch < 0:
        return {p: spark.createDataFrame([], _SCHEMAS[p]) for p in STATE_PARTS}
    return {p: spark.read.schema(_SCHEMAS[p]).parquet(f"{_state_path(path, batch)}/{p}") for p in STATE_PARTS}


def _drop_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _continued(dets: DataFrame, field: str, offsets: DataFrame) -> DataFrame:
    """Add what earlier batches counted of an address to a running number of the record."""
    cols = dets.columns
    off = offsets.select(F.col("src_ip").alias("_ip"), F.col("before").alias("_before"))
    number = F.col(f"info.{field}") + F.coalesce("_before", F.lit(0))       # null stays null
    return (dets.join(off, dets["device_ip"].eqNullSafe(off["_ip"]), "left")
            .withColumn("info", F.col("info").withField(field, number)).select(*cols))


def new_changes(state: dict[str, DataFrame], ready: DataFrame, clock: int) -> DataFrame:
    """Mapping changes of the rows in ``ready``, all of them later than ``clock``."""
    return R.mac_changes(state["recent"].unionByName(ready)).where(F.col("ts_us") > clock).select(
        "seq", "ts_us", "src_ip", "src_mac", "prev_ts_us", "prev_seq", "prev_src_mac")


def rules_step(state: dict[str, DataFrame], ready: DataFrame, changes: DataFrame, clock: int, gateways=None) -> DataFrame:
    """Detections of the rows in ``ready``, all of them later than ``clock``; ``changes`` are their mapping changes."""
    seen = state["recent"].unionByName(ready)
    every = state["changes"].unionByName(changes)
    # running numbers count what is in these tables; the rest of an address's past comes from its row
    here = (state["recent"].groupBy("src_ip").agg(F.count(F.lit(1)).alias("p"), F.lit(0).cast("long").alias("c"))
            .unionByName(state["changes"].groupBy("src_ip").agg(F.lit(0).cast("long").alias("p"), F.count(F.lit(1)).alias("c"))))
    before = (state["addresses"].select("src_ip", F.col("packets").alias("p"), F.col("changes").alias("c"))
              .unionByName(here.select("src_ip", (-F.col("p")).alias("p"), (-F.col("c")).alias("c")))
              .groupBy("src_ip").agg(F.sum("p").alias("p"), F.sum("c").alias("c")))
    d1 = _continued(R.rule_ip_mac_change(seen, changes=every), "change_number", before.select("src_ip", F.col("c").alias("before")))
    d2 = _continued(R.rule_duplicate_ip(seen), "total_claims", before.select("src_ip", F.col("p").alias("before")))
    d3 = R.rule_gateway_change(seen, gateways, changes=every)
    d4, d5 = R.mac_rules(seen)
    out = d1
    for d in (d2, d3, d4, d5):
        out = out.unionByName(d)
    return out.where(F.col("ts_us") > clock)


def _last_rows(rows: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("src_ip").orderBy(F.desc("ts_us"), F.desc("seq"))
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def run_batch(rows: DataFrame, batch: int, path: str, delay_us: int, gateways=None) -> None:
    """One micro-batch: late rows, detections and the next state, each in the batch's own folder."""
    spark = rows.sparkSession
    before, own = load_state(spark, path, batch - 1), _state_path(path, batch)
    clock = (before["clock"].first() or [START])[0]
    horizon = max(S.CHANGE_WINDOW_S, S.CLAIM_WINDOW_S, S.RATE_WINDOW_S, S.STORM_WINDOW_S) * S.US

    rows = rows.select("seq", "ts_us", "op", "src_ip", "src_mac", "dst_ip")
    late = F.col("ts_us").isNull() | (F.col("ts_us") <= clock)
    # read once; each later step reads the file
    rows.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(f"{own}/arrived")
    arrived = spark.read.schema(f"{_PACKET}, late boolean").option("basePath", f"{own}/arrived").parquet(f"{own}/arrived")
    arrived.where("late").drop("late").withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{path}/late/batch={batch}")

    waiting = before["pending"].unionByName(arrived.where(~F.col("late")).drop("late"))
    newest = waiting.agg(F.max("ts_us")).first()[0]
    now = clock if newest is None else max(clock, newest - delay_us)
    ready = waiting.where(F.col("ts_us") <= now)
    new_changes(before, ready, clock).write.mode("overwrite").parquet(f"{own}/new-changes")
    changes = spark.read.schema(_CHANGE).parquet(f"{own}/new-changes")
    rules_step(before, ready, changes, clock, gateways).write.mode("overwrite").parquet(f"{path}/detections/batch={batch}")

    waiting.where(F.col("ts_us") > now).write.mode("overwrite").parquet(f"{own}/pending")
    seen = before["recent"].unionByName(ready)
    edge = now - horizon
    last = seen.groupBy("src_ip").agg(F.max(F.struct("ts_us", "seq", "op", "src_mac", "dst_ip")).alias("l"))
    old = last.where(F.col("l.ts_us") <= edge).select("l.seq", "l.ts_us", "l.op", "src_ip", "l.src_mac", "l.dst_ip")
    seen.where(F.col("ts_us") > edge).unionByName(old).write.mode("overwrite").parquet(f"{own}/recent")
    every = before["changes"].unionByName(changes)
    (every.where(F.col("ts_us") > edge).unionByName(_last_rows(every, KEPT_CHANGES).where(F.col("ts_us") <= edge))
     .write.mode("overwrite").parquet(f"{own}/changes"))
    none = F.lit(0).cast("long")
    (before["addresses"]
     .unionByName(ready.groupBy("src_ip").agg(F.count(F.lit(1)).alias("packets"), none.alias("changes")))
     .unionByName(changes.groupBy("src_ip").agg(none.alias("packets"), F.count(F.lit(1)).alias("changes")))
     .groupBy("src_ip").agg(F.sum("packets").alias("packets"), F.sum("changes").alias("changes"))
     .write.mode("overwrite").parquet(f"{own}/addresses"))
    # the clock comes last: a state without it is of a batch that did not end
    spark.createDataFrame([(now,)], _SCHEMAS["clock"]).coalesce(1).write.mode("overwrite").parquet(f"{own}/clock")
    if batch > 1:
        _drop_folder(spark, _state_path(path, batch - 2))       # a retry needs the one before it alone


def stream_rules(packets: DataFrame, path: str, checkpoint: str, delay_seconds: int = 120, gateways=None, trigger: dict | None = None):
    """Start the query: detections in ``<path>/detections``, late rows in ``<path>/late``."""
    delay_us = delay_seconds * S.US

    def write(rows: DataFrame, batch: int) -> None:
        run_batch(rows, batch, path, delay_us, gateways)

    return (packets.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def detections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(R._none(spark.createDataFrame([], _PACKET), 1).schema).parquet(f"{path}/detections").drop("batch")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every late row with the number of the batch that brought it."""
    return spark.read.schema(LATE).option("recursiveFileLookup", "true").parquet(f"{path}/late")


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """Late rows by trigger and address, with how far back they reach."""
    return late_rows(spark, path).groupBy("batch", "src_ip").agg(
        F.count(F.lit(1)).alias("late_rows"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"))
