"""Keyed sliding-window primitives that hold up when one key is hot.

A key (one MAC, one IP) may carry a third of all packets, so nothing here
partitions by the key alone.  Every primitive also splits a key by time
bucket:

* **halo buckets** for look-backs of at most ``w``: a row is copied into the
  next bucket when it lies within ``w`` of that bucket's start, so each
  ``(key, bucket)`` partition holds everything its own rows can see;
* **bucket carry** for unbounded look-backs (previous row, last k rows,
  running counts): a small per-(key, bucket) summary is computed with a
  pre-aggregated group-by, passed forward with a window over the summary
  (one row per bucket) and joined back.

Windowed counts use enter/leave delta events and a running sum instead of a
``RANGE`` frame: Spark re-aggregates a moving frame row by row, which costs
O(rows x frame) on a flood; the running sum is O(rows) after the sort.

Order inside a key is arrival order ``(ts_us, seq)``: a row sees the rows of
its key with time in ``(t - w, t]`` that arrived no later than itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CARRY_BUCKET_US = 600 * 1_000_000


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _bucket(ts: str, b_us: int) -> Column:
    """Integer time bucket (exact integer division, no double rounding)."""
    return F.expr(f"`{ts}` div {int(b_us)}")


def default_halo_bucket(w_us: int) -> int:
    return 10 * w_us


def with_halo(df: DataFrame, keys, w_us: int, bucket_us: int | None = None,
              ts: str = "ts_us") -> DataFrame:
    """Assign rows to ``(key, _pb)`` partitions with a look-back halo of ``w``.

    Adds ``_pb`` (partition bucket) and ``_own`` (row belongs to this bucket);
    halo copies have ``_own = false``.  Repartitions by ``(keys, _pb)``.
    """
    b_us = bucket_us or default_halo_bucket(w_us)
    if b_us < w_us:
        raise ValueError("bucket must be at least as long as the window")
    b = _bucket(ts, b_us)
    nxt = b + 1
    copies = F.when(
        F.col(ts) + F.lit(w_us) > nxt * F.lit(b_us),
        F.array(F.struct(b.alias("pb"), F.lit(True).alias("own")),
                F.struct(nxt.alias("pb"), F.lit(False).alias("own"))),
    ).otherwise(F.array(F.struct(b.alias("pb"), F.lit(True).alias("own"))))
    out = (df.withColumn("_h", F.explode(copies))
           .withColumn("_pb", F.col("_h.pb")).withColumn("_own", F.col("_h.own")).drop("_h"))
    return out.repartition(*_cols(keys), "_pb")


def _running_delta(events: DataFrame, keys, out: str | None, count_out: str | None = None) -> DataFrame:
    w = (Window.partitionBy(*_cols(keys), "_pb").orderBy("_t", "_kind", "_seq")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if out:
        events = events.withColumn(out, F.sum("_d").over(w))
    if count_out:
        events = events.withColumn(count_out, F.sum("_c").over(w))
    return events


def _explode_events(df: DataFrame, enter: Column, leave_at: Column, seq: str,
                    count_leave_at: Column | None = None) -> DataFrame:
    """Each row -> its own (enter, query) event plus leave events.

    ``_d`` carries the distinct-count delta, ``_c`` the plain-count delta.
    """
    count_leave_at = leave_at if count_leave_at is None else count_leave_at
    ev = F.array(
        F.struct(F.col("ts_us").alias("t"), F.lit(1).alias("kind"), enter.cast("long").alias("d"),
                 F.lit(1).cast("long").alias("c"), F.col("_own").alias("q")),
        F.struct(leave_at.alias("t"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("d"),
                 F.lit(0).cast("long").alias("c"), F.lit(False).alias("q")),
        F.struct(count_leave_at.alias("t"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("d"),
                 F.lit(-1).cast("long").alias("c"), F.lit(False).alias("q")),
    )
    x = df.withColumn("_e", F.explode(ev)).where(F.col("_e.t").isNotNull())
    return x.select(
        *[c for c in df.columns if c != "_own"],
        F.col("_e.t").alias("_t"), F.col("_e.kind").alias("_kind"), F.col("_e.d").alias("_d"),
        F.col("_e.c").alias("_c"), F.col("_e.q").alias("_q"), F.col(seq).alias("_seq"),
    )


def sliding_count(df: DataFrame, keys, w_us: int, out: str, bucket_us: int | None = None,
                  seq: str = "seq") -> DataFrame:
    """Rows of the same key in ``(t - w, t]`` up to and including this row."""
    keys = _cols(keys)
    h = with_halo(df, keys, w_us, bucket_us)
    b_us = bucket_us or default_halo_bucket(w_us)
    leave = F.col("ts_us") + F.lit(w_us)
    leave = F.when(leave < (F.col("_pb") + 1) * F.lit(b_us), leave)
    ev = _explode_events(h, F.lit(1), F.lit(None).cast("long"), seq, count_leave_at=leave)
    res = _running_delta(ev, keys, None, out)
    return res.where(F.col("_q")).drop("_t", "_kind", "_d", "_c", "_q", "_seq", "_pb")


def sliding_distinct(df: DataFrame, keys, value: str, w_us: int, out: str,
                     bucket_us: int | None = None, seq: str = "seq",
                     count_out: str | None = None) -> DataFrame:
    """Distinct non-null ``value`` among rows of the key in ``(t - w, t]`` (arrival order).

    With ``count_out`` the plain row count of the same frame comes out of the
    same pass.
    """
    keys = _cols(keys)
    b_us = bucket_us or default_halo_bucket(w_us)
    h = with_halo(df, keys, w_us, b_us)
    return distinct_on_halo(h, keys, value, w_us, out, b_us, seq, count_out)


def distinct_on_halo(h: DataFrame, keys, value: str, w_us: int, out: str, bucket_us: int,
                     seq: str = "seq", count_out: str | None = None, keep_all: bool = False) -> DataFrame:
    """``sliding_distinct`` on a frame already laid out by ``with_halo``.

    With ``keep_all`` every laid-out row (halo copies too) comes back with
    ``_pb`` and ``_own``, still partitioned and sorted by ``(key, bucket)``,
    so later per-group steps need no new shuffle; the measure is meaningful
    on ``_own`` rows.
    """
    keys = _cols(keys)
    b_us = bucket_us
    wv = Window.partitionBy(*keys, "_pb", value).orderBy("ts_us", seq)
    h = (h.withColumn("_prev_t", F.lag("ts_us").over(wv))
          .withColumn("_next_t", F.lead("ts_us").over(wv)))
    present = F.col(value).isNotNull()
    enter = present & (F.col("_prev_t").isNull() | (F.col("ts_us") - F.col("_prev_t") >= F.lit(w_us)))
    leave_t = F.col("ts_us") + F.lit(w_us)
    leave = F.when(
        present & (F.col("_next_t").isNull() | (F.col("_next_t") - F.col("ts_us") >= F.lit(w_us)))
        & (leave_t < (F.col("_pb") + 1) * F.lit(b_us)), leave_t)
    count_leave = F.when(leave_t < (F.col("_pb") + 1) * F.lit(b_us), leave_t)
    h = h.withColumn("_enter", enter).withColumn("_leave", leave).withColumn("_cleave", count_leave)
    ev = _explode_events(h.drop("_prev_t", "_next_t"), F.col("_enter"), F.col("_leave"), seq,
                         count_leave_at=F.col("_cleave")).drop("_enter", "_leave", "_cleave")
    res = _running_delta(ev, keys, out, count_out)
    if keep_all:
        return res.where(F.col("_kind") == 1).withColumn("_own", F.col("_q")) \
            .drop("_t", "_kind", "_d", "_c", "_q", "_seq")
    return res.where(F.col("_q")).drop("_t", "_kind", "_d", "_c", "_q", "_seq", "_pb")


def running_count(df: DataFrame, keys, out: str, bucket_us: int = DEFAULT_CARRY_BUCKET_US,
                  seq: str = "seq") -> DataFrame:
    """Inclusive count of earlier-or-same rows of the key in arrival order.

    Row number inside ``(key, bucket)`` plus the rows of all earlier buckets,
    taken from a per-bucket count and a prefix sum over the bucket summary.
    The summary is aggregated from the windowed frame itself, which is
    already partitioned by ``(key, bucket)``: no second shuffle of the input
    and no second evaluation of its lineage (the exchange is reused).
    """
    keys = _cols(keys)
    b = df.withColumn("_b", _bucket("ts_us", bucket_us))
    local = b.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*keys, "_b").orderBy("ts_us", seq)))
    totals = local.groupBy(*keys, "_b").agg(F.max("_rn").alias("_bn"))
    totals = totals.withColumn("_off", F.coalesce(F.sum("_bn").over(
        Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0).cast("long"))).drop("_bn")
    res = local.join(totals, keys + ["_b"], "left")
    return res.withColumn(out, F.col("_rn") + F.col("_off")).drop("_b", "_rn", "_off")


def last_k_before(df: DataFrame, keys, payload: list[str], k: int, out: str,
                  bucket_us: int = DEFAULT_CARRY_BUCKET_US, seq: str = "seq") -> DataFrame:
    """Array of the last ``k`` earlier rows of the key (all time), oldest first.

    Each entry is ``struct(ts_us, seq, *payload)``.  Inside a bucket a bounded
    ``ROWS k PRECEDING`` frame gives the local part; for the first rows of a
    bucket the tail of the previous non-empty buckets (at most k rows each,
    k buckets back) is carried forward and joined on ``(key, bucket)``.
    """
    keys = _cols(keys)
    entry = F.struct(F.col("ts_us"), F.col(seq).alias("seq"), *[F.col(c) for c in payload])
    b = df.withColumn("_b", _bucket("ts_us", bucket_us))
    wl = Window.partitionBy(*keys, "_b").orderBy("ts_us", seq)
    local = (b.withColumn("_e", entry)
              .withColumn("_local", F.collect_list("_e").over(wl.rowsBetween(-k, -1)))
              .withColumn("_rn", F.row_number().over(wl)))
    # bucket tail = the last k rows: the local frame of the last row plus that row
    tails = (local.groupBy(*keys, "_b")
             .agg(F.max_by(F.concat(F.col("_local"), F.array("_e")), F.col("_rn")).alias("_t"))
             .select(*keys, "_b", F.slice("_t", F.greatest(F.size("_t") - F.lit(k - 1), F.lit(1)), F.lit(k))
                     .alias("_tail")))
    carry = tails.withColumn(
        "_carry", F.flatten(F.collect_list("_tail").over(
            Window.partitionBy(*keys).orderBy("_b").rowsBetween(-k, -1)))).drop("_tail")
    res = local.join(carry, keys + ["_b"], "left")
    # entries from carry and local never overlap: carry is strictly before the bucket
    merged = F.concat(F.sort_array(F.coalesce(F.col("_carry"), F.slice(F.col("_local"), 1, 0))), F.col("_local"))
    start = F.greatest(F.size(merged) - F.lit(k - 1), F.lit(1))
    return (res.withColumn(out, F.slice(merged, start, F.lit(k)))
            .drop("_b", "_local", "_rn", "_carry", "_e"))


def prev_in_key(df: DataFrame, keys, cols: list[str], bucket_us: int = DEFAULT_CARRY_BUCKET_US,
                seq: str = "seq", prefix: str = "prev_") -> DataFrame:
    """Previous row of the key (any distance back): ``prev_ts_us``, ``prev_seq``, ``prev_<col>``.

    ``lag`` inside ``(key, bucket)``; the first row of a bucket takes the last
    row of the nearest earlier non-empty bucket, found with a partially
    aggregated ``max_by`` per bucket and a ``lag`` over the bucket summary.
    """
    keys = _cols(keys)
    payload = ["ts_us", seq] + list(cols)
    b = df.withColumn("_b", _bucket("ts_us", bucket_us))
    wl = Window.partitionBy(*keys, "_b").orderBy("ts_us", seq)
    local = b.withColumn("_lp", F.lag(F.struct(*[F.col(c) for c in payload])).over(wl))
    # summary from the windowed frame: same partitioning, exchange reused
    tails = local.groupBy(*keys, "_b").agg(
        F.max_by(F.struct(*[F.col(c) for c in payload]), F.struct("ts_us", seq)).alias("_tail"))
    carry = tails.withColumn("_carry", F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_b"))) \
        .drop("_tail").where(F.col("_carry").isNotNull())
    res = local.join(carry, keys + ["_b"], "left")
    last = F.coalesce(F.col("_lp"), F.col("_carry"))
    names = {"ts_us": prefix + "ts_us", seq: prefix + "seq"}
    return (res.withColumn("_last", last)
            .select(*[c for c in res.columns if c not in ("_lp", "_carry", "_b")],
                    *[F.col(f"_last.{c}").alias(names.get(c, prefix + c)) for c in payload]))
