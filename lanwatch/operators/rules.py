"""Detection rules D1–D10 over packet tables.

Each rule is a function ``packets -> detections`` (one row per firing
packet, common schema ``DETECTION_COLUMNS``).  Rules read packet time only
(never the wall clock), in arrival order ``(ts_us, seq)``.

``semantics="documented"`` (default) follows the documented intent: a packet
is compared with the state *before* it.  ``semantics="observed"`` reproduces
what the per-packet engine actually emits: rules 1 and 3 never fire (state is
updated before they look), the rate rule sees every packet twice in a
200-entry buffer, the storm rule sees the last 50 requests twice.

Sliding measures come from ``sliding`` (hot-key safe, exact); the member
lists of rules 2 and 5 come from an interval join (``intervals``) in the
(key, time bucket) groups that contain a firing packet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mac import normalize_mac
from .. import schema as S
from ..session import materialize
from . import intervals as I
from . import sliding as SL

SEMANTICS = ("documented", "observed")

INFO_TYPE = T.StructType([
    T.StructField("previous_mac", T.StringType()),
    T.StructField("new_mac", T.StringType()),
    T.StructField("change_number", T.LongType()),
    T.StructField("change_count", T.LongType()),
    T.StructField("change_history", T.ArrayType(T.StructType([
        T.StructField("mac", T.StringType()), T.StructField("ts_us", T.LongType())]))),
    T.StructField("claiming_mac_count", T.LongType()),
    T.StructField("total_claims", T.LongType()),
    T.StructField("claiming_macs", T.ArrayType(T.StringType())),
    T.StructField("claims_per_mac", T.MapType(T.StringType(), T.LongType())),
    T.StructField("is_arp_spoofing", T.BooleanType()),
    T.StructField("gateway_history", T.ArrayType(T.StructType([
        T.StructField("mac", T.StringType()), T.StructField("ts_us", T.LongType())]))),
    T.StructField("packet_count", T.LongType()),
    T.StructField("threshold", T.IntegerType()),
    T.StructField("is_flood", T.BooleanType()),
    T.StructField("time_window", T.IntegerType()),
    T.StructField("unique_targets", T.LongType()),
    T.StructField("total_requests", T.LongType()),
    T.StructField("target_ips", T.ArrayType(T.StringType())),
])

DETECTION_COLUMNS = ["detection_id", "rule_no", "rule", "seq", "ts_us", "event_type", "severity",
                     "reason", "device_ip", "device_mac", "info"]

# Rule names and reason formats.
RULE_NAMES = {
    1: "IP-MAC Change Detection",
    2: "Duplicate IP Claim Detection",
    3: "Gateway Change Detection",
    4: "Unusual ARP Activity",
    5: "ARP Request Storm",
}
REASON_RAPID = "Rapid MAC changes detected for IP %s: %d changes in %ds"
REASON_CHANGE = "MAC change for IP %s: %s -> %s"
REASON_CLAIM = "IP %s claimed by %d different MACs: %s..."
REASON_GATEWAY = "\U0001F6A8 GATEWAY ATTACK: Gateway %s MAC changed from %s to %s"
REASON_RATE = "Abnormal ARP rate from %s: %d packets in last minute"
REASON_STORM = "ARP scanning detected from %s: scanning %d unique IPs in %ds"

US = S.US

BROADCAST_IPS = 100_000     # contested IPs that are broadcast
SALTS = 16                  # parts of the packets of an IP, if there are more


def _info(**fields: Column) -> Column:
    parts = []
    for f in INFO_TYPE.fields:
        v = fields.get(f.name)
        parts.append((v if v is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return F.struct(*parts)


def detection_id(rule_no: Column) -> Column:
    """Deterministic id over rule, time, IP, MAC and packet, so a re-run rewrites the same rows and
    captures, whose packet numbers start alike, do not share ids."""
    return F.sha2(F.concat_ws("|", rule_no.cast("string"), F.col("ts_us").cast("string"),
                              F.coalesce("src_ip", F.lit("")), F.coalesce("src_mac", F.lit("")),
                              F.col("seq").cast("string")), 256)


def _detections(df: DataFrame, rule_no: int, event_type: Column, severity: Column,
                reason: Column, info: Column) -> DataFrame:
    return df.select(
        detection_id(F.lit(rule_no)).alias("detection_id"),
        F.lit(rule_no).alias("rule_no"), F.lit(RULE_NAMES.get(rule_no, f"rule {rule_no}")).alias("rule"),
        "seq", "ts_us", event_type.alias("event_type"), severity.alias("severity"),
        reason.alias("reason"), F.col("src_ip").alias("device_ip"), F.col("src_mac").alias("device_mac"),
        info.alias("info"),
    )


def build_detections(rows: DataFrame, rule_no: int, event_type: Column, severity: Column, reason: Column,
                     **info: Column) -> DataFrame:
    """Detections of a user's rule (D10) from its firing packets; ``info`` takes fields of ``INFO_TYPE``."""
    return _detections(rows, rule_no, event_type, severity, reason, _info(**info))


def _none(packets: DataFrame, rule_no: int) -> DataFrame:
    empty = packets.where(F.lit(False))
    return _detections(empty, rule_no, F.lit(None).cast("string"), F.lit(None).cast("string"),
                       F.lit(None).cast("string"), _info())


def _check(semantics: str):
    if semantics not in SEMANTICS:
        raise ValueError(f"semantics must be one of {SEMANTICS}")


def _pk(packets: DataFrame) -> DataFrame:
    return packets.select("seq", "ts_us", "op", "src_ip", "src_mac", "dst_ip")


# ------------------------------------------------------------ window members

def firing_members(laid: DataFrame, keys, n_distinct: str, w_us: int, min_distinct: int,
                   passthrough, max_members: int | None = None) -> DataFrame:
    """Members of the window of each firing row of a halo-laid frame, by an interval join.

    A row fires if it is its bucket's own and ``n_distinct`` reaches ``min_distinct``.  Only ``(key, bucket)``
    groups that hold a firing row go on.  There each row enters at its place and leaves ``w`` later; between two
    events of a value its count is constant, which gives intervals (value, count, from, to) in places of the group.
    ``intervals.covering`` meets firing rows and intervals by equality on blocks of places, so a hot group is
    spread and no pair is tried in vain.

    With ``max_members`` the members are the smallest values, without counts, from the merged stretches in which a
    value is present.  ``laid`` must come partitioned by ``(key, _pb)``: the windows here add no shuffle.
    Result: keys, ``_pb``, ``passthrough``, seq, ts_us, n_distinct, n_rows (rows in the window), own_rank (the
    row's number among its bucket's own rows), members (sorted; value, n).
    """
    keys = SL._cols(keys)
    group = [*keys, "_pb"]
    cols = [c for c in dict.fromkeys(passthrough) if c not in keys]
    whole = Window.partitionBy(*group)
    fires = F.col("_own") & (F.col(n_distinct) >= min_distinct)
    x = (laid.select(*dict.fromkeys([*group, *cols, "ts_us", "seq", "_v", "_own"]), F.col(n_distinct).alias("n_distinct"), fires.alias("_f"))
         .withColumn("_any", F.max("_f").over(whole)).withColumn("_size", 2 * F.count(F.lit(1)).over(whole))
         .where("_any").drop("_any"))
    event = F.explode(F.array(
        F.struct(F.col("ts_us").alias("t"), F.lit(1).alias("kind"), F.lit(1).cast("long").alias("d")),
        F.struct((F.col("ts_us") + F.lit(w_us)).alias("t"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("d"))))
    order = Window.partitionBy(*group).orderBy("_e.t", "_e.kind", "seq")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = (x.withColumn("_e", event)
         .withColumn("_pos", (F.row_number().over(order) - 1).cast("long"))
         .withColumn("n_rows", F.sum("_e.d").over(so_far))
         .withColumn("own_rank", F.sum((F.col("_own") & (F.col("_e.kind") == 1)).cast("long")).over(so_far)))
    by_value = Window.partitionBy(*group, "_v").orderBy("_pos")
    steps = (e.where(F.col("_v").isNotNull())
             .withColumn("_n", F.sum("_e.d").over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    if max_members is not None:
        # where a value appears and where it is gone again
        steps = steps.where(F.col("_n") == F.col("_e.kind"))
    steps = (steps.withColumn("_to", F.lead("_pos").over(by_value)).where(F.col("_n") > 0)
             .withColumnRenamed("_pos", "_from"))
    n = F.lit(None).cast("long") if max_members is not None else F.col("_n")
    points = e.where(F.col("_f") & (F.col("_e.kind") == 1)).select(
        *group, "_pos", "_size", *cols, "ts_us", "seq", "n_distinct", "n_rows", "own_rank")
    return (I.covering(points, steps, group, F.struct(F.col("_v").alias("value"), n.alias("n")), max_members)
            .withColumnRenamed("_items", "members"))


def window_members(rows: DataFrame, keys, value: str, w_us: int, min_distinct: int,
                   passthrough=(), bucket_us: int | None = None, max_members: int | None = None) -> DataFrame:
    """Rows whose key window ``(t - w, t]`` holds at least ``min_distinct`` distinct ``value``s, with the members.

    One shuffle lays the packets out by ``(key, time bucket)`` with a look-back halo; delta events measure every
    row; ``firing_members`` lists the members of those that fire.
    """
    keys = SL._cols(keys)
    cols = list(dict.fromkeys(list(keys) + list(passthrough)))
    b_us = bucket_us or SL.default_halo_bucket(w_us)
    base = rows.select(*cols, "ts_us", "seq", F.col(value).cast("string").alias("_v"))
    laid = SL.distinct_on_halo(SL.with_halo(base, keys, w_us, b_us), keys, "_v", w_us, "_n", b_us,
                               keep_all=True)
    return firing_members(laid, keys, "_n", w_us, min_distinct, cols, max_members)


# ------------------------------------------------------------ D1 / D3 shared

def mac_changes(packets: DataFrame, bucket_us: int = SL.DEFAULT_CARRY_BUCKET_US) -> DataFrame:
    """Packets whose sender MAC differs from the previous packet of the same IP."""
    x = SL.prev_in_key(_pk(packets), "src_ip", ["src_mac"], bucket_us)
    return x.where(F.col("prev_src_mac").isNotNull() & (F.col("prev_src_mac") != F.col("src_mac")))


def _change_measures(ch: DataFrame, w_us: int) -> DataFrame:
    """For change rows, in one halo partitioning by (IP, bucket):
    ``_recent`` changes in ``(t - w, t]`` up to this one (delta events),
    ``_hist`` the five changes before it (bounded ROWS frame; older than ``w``
    is filtered later, so the halo suffices) and ``change_number`` (rank in
    the bucket plus the changes of all earlier buckets, carried forward)."""
    b_us = SL.default_halo_bucket(w_us)
    h = SL.with_halo(ch, "src_ip", w_us, b_us)
    wo = Window.partitionBy("src_ip", "_pb").orderBy("ts_us", "seq")
    entry = F.struct("ts_us", "seq", "prev_src_mac")
    h = (h.withColumn("_hist", F.collect_list(entry).over(wo.rowsBetween(-5, -1)))
          .withColumn("_rank", F.sum(F.col("_own").cast("long")).over(wo.rowsBetween(Window.unboundedPreceding, 0))))
    leave = F.col("ts_us") + F.lit(w_us)
    leave = F.when(leave < (F.col("_pb") + 1) * F.lit(b_us), leave)
    ev = SL._explode_events(h, F.lit(1), F.lit(None).cast("long"), "seq", count_leave_at=leave)
    res = SL._running_delta(ev, "src_ip", None, "_recent").where("_q")
    # per-bucket change counts (own rows) -> offsets of earlier buckets
    per_bucket = res.groupBy("src_ip", "_pb").agg(F.max("_rank").alias("_n"))
    offsets = per_bucket.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.partitionBy("src_ip").orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0).cast("long"))).drop("_n")
    res = res.join(offsets, ["src_ip", "_pb"], "left")
    return (res.withColumn("change_number", F.col("_rank") + F.col("_off"))
            .drop("_t", "_kind", "_d", "_c", "_q", "_seq", "_pb", "_rank", "_off"))


def rule_ip_mac_change(packets: DataFrame, semantics: str = "documented",
                       window_s: int = S.CHANGE_WINDOW_S, rapid: int = S.RAPID_CHANGES,
                       changes: DataFrame | None = None) -> DataFrame:
    """MAC differs from the IP's previous MAC; >= ``rapid`` earlier changes in
    the window -> ARP_SPOOFING_ATTACK / CRITICAL, else IP_MAC_MAPPING_CHANGE / MEDIUM."""
    _check(semantics)
    if semantics == "observed":
        return _none(packets, 1)
    w_us = window_s * US
    ch = _change_measures(changes if changes is not None else materialize(mac_changes(packets)), w_us)
    earlier = F.col("_recent") - 1
    is_rapid = earlier >= rapid
    hist = F.transform(
        F.filter(F.col("_hist"), lambda e: e["ts_us"] > F.col("ts_us") - F.lit(w_us)),
        lambda e: F.struct(e["prev_src_mac"].alias("mac"), e["ts_us"].alias("ts_us")))
    return _detections(
        ch, 1,
        F.when(is_rapid, "ARP_SPOOFING_ATTACK").otherwise("IP_MAC_MAPPING_CHANGE"),
        F.when(is_rapid, "CRITICAL").otherwise("MEDIUM"),
        F.when(is_rapid, F.format_string(REASON_RAPID, F.col("src_ip"), earlier, F.lit(window_s)))
         .otherwise(F.format_string(REASON_CHANGE, F.col("src_ip"), F.col("prev_src_mac"), F.col("src_mac"))),
        _info(previous_mac=F.col("prev_src_mac"),
              new_mac=F.when(~is_rapid, F.col("src_mac")),
              change_number=F.when(~is_rapid, F.col("change_number")),
              change_count=F.when(is_rapid, earlier),
              change_history=F.when(is_rapid, hist)),
    )


def rule_gateway_change(packets: DataFrame, gateways=None, semantics: str = "documented",
                        changes: DataFrame | None = None) -> DataFrame:
    """D3 (+D8): a gateway IP's MAC changed; always GATEWAY_MAPPING_CHANGE / CRITICAL.

    The gateway list is a small driver-side parameter; the filter is pushed
    into the scan before any shuffle.  ``gateway_history`` holds the last five
    (new MAC, time) changes of the gateway, this one included.
    """
    _check(semantics)
    gws = list(gateways) if gateways else list(S.DEFAULT_GATEWAYS)
    if semantics == "observed":
        return _none(packets, 3)
    if changes is not None:
        ch = changes.where(F.col("src_ip").isin(gws))
    else:
        ch = mac_changes(packets.where(F.col("src_ip").isin(gws)))
    ch = SL.last_k_before(ch, "src_ip", ["src_mac"], 4, "_gh")
    hist = F.concat(
        F.transform("_gh", lambda e: F.struct(e["src_mac"].alias("mac"), e["ts_us"].alias("ts_us"))),
        F.array(F.struct(F.col("src_mac").alias("mac"), F.col("ts_us").alias("ts_us"))))
    return _detections(
        ch, 3, F.lit("GATEWAY_MAPPING_CHANGE"), F.lit("CRITICAL"),
        F.format_string(REASON_GATEWAY, F.col("src_ip"), F.col("prev_src_mac"), F.col("src_mac")),
        _info(previous_mac=F.col("prev_src_mac"), new_mac=F.col("src_mac"),
              is_arp_spoofing=F.lit(True), gateway_history=hist),
    )


# ------------------------------------------------------------ D2

def rule_duplicate_ip(packets: DataFrame, semantics: str = "documented",
                      window_s: int = S.CLAIM_WINDOW_S, high: int = S.CLAIMS_HIGH,
                      critical: int = S.CLAIMS_CRITICAL, bucket_us: int | None = None) -> DataFrame:
    """Distinct MACs claiming the IP in the window, this packet included.

    ``total_claims`` (all-time claims of the IP up to this packet) is the
    packet's rank in its bucket plus the claims of all earlier buckets (a
    per-bucket count, pre-aggregated, prefix-summed over the bucket summary).
    """
    _check(semantics)
    w_us = window_s * US
    b_us = bucket_us or SL.default_halo_bucket(w_us)
    pk = _pk(packets)
    hits = window_members(pk, "src_ip", "src_mac", w_us, high, passthrough=["src_mac"], bucket_us=b_us)
    per_bucket = pk.groupBy("src_ip", SL._bucket("ts_us", b_us).alias("_pb")).agg(F.count(F.lit(1)).alias("_c"))
    offsets = per_bucket.withColumn("_off", F.coalesce(F.sum("_c").over(
        Window.partitionBy("src_ip").orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0).cast("long"))).drop("_c")
    y = hits.join(offsets, ["src_ip", "_pb"], "left")
    macs = F.transform("members", lambda m: m["value"])
    n = F.col("n_distinct")
    return _detections(
        y, 2, F.lit("DUPLICATE_IP_CLAIM"),
        F.when(n >= critical, "CRITICAL").otherwise("HIGH"),
        F.format_string(REASON_CLAIM, F.col("src_ip"), n, F.array_join(F.slice(macs, 1, 3), ", ")),
        _info(claiming_mac_count=n, total_claims=F.col("own_rank") + F.col("_off"),
              claiming_macs=macs,
              claims_per_mac=F.map_from_arrays(macs, F.transform("members", lambda m: m["n"]))),
    )


# ------------------------------------------------------------ D4

def rule_unusual_rate(packets: DataFrame, semantics: str = "documented",
                      window_s: int = S.RATE_WINDOW_S, limit: int = S.RATE_LIMIT,
                      flood: int = S.FLOOD_LIMIT) -> DataFrame:
    """Packets per sender MAC in the window: > limit HIGH, > flood CRITICAL."""
    _check(semantics)
    x = SL.sliding_count(_pk(packets), "src_mac", window_s * US, "_n")
    if semantics == "observed":
        c = 2 * F.least(F.col("_n"), F.lit(S.RATE_STATE_CAP // 2))
    else:
        c = F.col("_n")
    x = x.withColumn("_c", c).where(F.col("_c") > limit)
    is_flood = F.col("_c") > flood
    return _detections(
        x, 4, F.when(is_flood, "MAC_FLOODING").otherwise("UNUSUAL_ARP_ACTIVITY"),
        F.when(is_flood, "CRITICAL").otherwise("HIGH"),
        F.format_string(REASON_RATE, F.col("src_mac"), F.col("_c")),
        _info(packet_count=F.col("_c"), threshold=F.lit(limit), is_flood=is_flood,
              time_window=F.lit(window_s)),
    )


# ------------------------------------------------------------ D5

def rule_request_storm(packets: DataFrame, semantics: str = "documented",
                       window_s: int = S.STORM_WINDOW_S, targets: int = S.STORM_TARGETS) -> DataFrame:
    """Requests only; distinct target IPs per sender MAC in the window > targets.

    A request without a target counts as a request, not as a target, in either mode.
    """
    _check(semantics)
    w_us = window_s * US
    req = _pk(packets).where(F.col("op") == S.OP_REQUEST)
    if semantics == "observed":
        # The engine keeps each request twice in a 100-entry buffer: it sees the
        # last 50 requests, then drops those older than the window.
        cap = S.REQUEST_STATE_CAP // 2
        h = SL.with_halo(req, "src_mac", w_us)
        wl = Window.partitionBy("src_mac", "_pb").orderBy("ts_us", "seq").rowsBetween(-(cap - 1), 0)
        h = h.withColumn("_last", F.collect_list(F.struct("ts_us", "dst_ip")).over(wl)).where("_own")
        recent = F.filter("_last", lambda e: e["ts_us"] > F.col("ts_us") - F.lit(w_us))
        h = (h.withColumn("_tg", F.array_sort(F.array_distinct(F.array_compact(F.transform(recent, lambda e: e["dst_ip"])))))
              .withColumn("_u", F.size("_tg").cast("long"))
              .withColumn("_r", (2 * F.size(recent)).cast("long"))
              .where(F.col("_u") > targets)
              .withColumn("_targets", F.slice("_tg", 1, 10)))
        fired = h
    else:
        fired = (window_members(req, "src_mac", "dst_ip", w_us, targets + 1, passthrough=["src_ip"],
                                max_members=10)
                 .withColumn("_u", F.col("n_distinct")).withColumn("_r", F.col("n_rows"))
                 .withColumn("_targets", F.slice(F.transform("members", lambda m: m["value"]), 1, 10)))
    return _detections(
        fired, 5, F.lit("ARP_REQUEST_STORM"), F.lit("HIGH"),
        F.format_string(REASON_STORM, F.col("src_mac"), F.col("_u"), F.lit(window_s)),
        _info(unique_targets=F.col("_u"), total_requests=F.col("_r"), target_ips=F.col("_targets"),
              time_window=F.lit(window_s)),
    )


# ------------------------------------------------------------ D1 + D2 + D3 in one layout

def contested_packets(packets: DataFrame) -> DataFrame:
    """All packets of the sender IPs that were seen with more than one MAC (null counts as one).

    An IP with one MAC has no change and no conflict, and no second MAC claims it; what compares the MACs of an IP
    needs these packets only.  The distinct (IP, MAC) pairs are counted with a partial aggregation.  Few contested
    IPs are broadcast; many are joined over ``SALTS`` parts of an IP's packets, so that a hot IP is spread.
    """
    several = materialize(packets.select("src_ip", "src_mac").distinct().groupBy("src_ip")
                          .agg(F.count(F.lit(1)).alias("_macs")).where(F.col("_macs") > 1)
                          .select(F.col("src_ip").alias("_ip")))
    pk = packets.select("seq", "ts_us", "src_ip", "src_mac")
    same_ip = F.col("src_ip").eqNullSafe(F.col("_ip"))
    if several.count() <= BROADCAST_IPS:
        return materialize(pk.join(F.broadcast(several), same_ip, "left_semi"))
    parts = several.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    part = F.pmod(F.xxhash64("seq", "ts_us"), F.lit(SALTS).cast("long"))
    return materialize(pk.join(parts, same_ip & (part == F.col("_part")), "left_semi"))


def ip_rules(packets: DataFrame, gateways=None, change_window_s: int = S.CHANGE_WINDOW_S,
             claim_window_s: int = S.CLAIM_WINDOW_S, high: int = S.CLAIMS_HIGH,
             critical: int = S.CLAIMS_CRITICAL,
             contested: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rules 1, 2 and 3 (documented semantics) from one shuffle of the contested packets.

    Only IPs with several MACs can fire (``contested_packets``, which a caller may bring); all packets are laid out
    only if one claimed MAC is enough for rule 2.
    One halo layout by ``(sender IP, bucket)`` serves: the firing-group pass
    and member lists of rule 2 and its per-bucket claim offsets; and the
    previous packet of every packet for rules 1 and 3 (``lag`` in the
    partition, whose halo rows are real earlier packets; only the first row
    of a partition without halo rows takes the last row of the nearest
    earlier bucket from a small carry table).  Equal to the rules run
    separately.
    """
    gws = list(gateways) if gateways else list(S.DEFAULT_GATEWAYS)
    w2 = claim_window_s * US
    b_us = SL.default_halo_bucket(max(w2, change_window_s * US))
    if high < 2:
        contested = packets
    elif contested is None:
        contested = contested_packets(packets)
    # one shuffle, read by every later step
    base = contested.select("src_ip", "ts_us", "seq", F.col("src_mac").alias("_v"))
    laid = materialize(SL.distinct_on_halo(SL.with_halo(base, "src_ip", w2, b_us), "src_ip", "_v", w2, "_n", b_us,
                                           keep_all=True))
    # ---- rule 2: members of firing rows, claim offsets per bucket
    fired = firing_members(laid.withColumn("src_mac", F.col("_v")), "src_ip", "_n", w2, high, ["src_mac"])
    per_bucket = laid.where("_own").groupBy("src_ip", "_pb").agg(F.count(F.lit(1)).alias("_c"))
    offsets = per_bucket.withColumn("_off", F.coalesce(F.sum("_c").over(
        Window.partitionBy("src_ip").orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0).cast("long"))).drop("_c")
    y = fired.join(offsets, ["src_ip", "_pb"], "left")
    macs = F.transform("members", lambda m: m["value"])
    n = F.col("n_distinct")
    det2 = _detections(
        y, 2, F.lit("DUPLICATE_IP_CLAIM"), F.when(n >= critical, "CRITICAL").otherwise("HIGH"),
        F.format_string(REASON_CLAIM, F.col("src_ip"), n, F.array_join(F.slice(macs, 1, 3), ", ")),
        _info(claiming_mac_count=n, total_claims=F.col("own_rank") + F.col("_off"), claiming_macs=macs,
              claims_per_mac=F.map_from_arrays(macs, F.transform("members", lambda m: m["n"]))))
    # ---- rules 1 and 3: previous packet of the IP (halo rows are real earlier packets)
    wl = Window.partitionBy("src_ip", "_pb").orderBy("ts_us", "seq")
    entry = F.struct("ts_us", "seq", F.col("_v").alias("src_mac"))
    x = laid.withColumn("_lp", F.lag(entry).over(wl)).where("_own")
    tails = x.groupBy("src_ip", "_pb").agg(F.max_by(entry, F.struct("ts_us", "seq")).alias("_tail"))
    carry = (tails.withColumn("_carry", F.lag("_tail").over(Window.partitionBy("src_ip").orderBy("_pb")))
             .drop("_tail").where(F.col("_carry").isNotNull()))
    x = x.join(carry, ["src_ip", "_pb"], "left").withColumn("_last", F.coalesce("_lp", "_carry"))
    ch = x.select("seq", "ts_us", "src_ip", F.col("_v").alias("src_mac"),
                  F.col("_last.ts_us").alias("prev_ts_us"), F.col("_last.seq").alias("prev_seq"),
                  F.col("_last.src_mac").alias("prev_src_mac")) \
        .where(F.col("prev_src_mac").isNotNull() & (F.col("prev_src_mac") != F.col("src_mac")))
    ch = materialize(ch)
    det1 = rule_ip_mac_change(packets, window_s=change_window_s, changes=ch)
    det3 = rule_gateway_change(packets, gws, changes=ch)
    return det1, det2, det3


# ------------------------------------------------------------ D4 + D5 in one layout

def mac_rules(packets: DataFrame, rate_window_s: int = S.RATE_WINDOW_S, limit: int = S.RATE_LIMIT,
              flood: int = S.FLOOD_LIMIT, storm_window_s: int = S.STORM_WINDOW_S,
              targets: int = S.STORM_TARGETS) -> tuple[DataFrame, DataFrame]:
    """Rules 4 and 5 (documented semantics) from one shuffle of the packets.

    One halo layout by ``(sender MAC, bucket)`` (look-back = the longer
    window) serves both rules.  One running-sum window carries three deltas:
    packets in 60 s (rule 4), distinct request targets and requests in 30 s
    (rule 5).  A group with too few packets for rule 4 and too few requests
    for rule 5 can't fire and is left before that.  The layout is written
    once for the detections of rule 4 and the member lists of rule 5.  Equal
    to ``rule_unusual_rate`` and ``rule_request_storm`` run separately.
    """
    w4, w5 = rate_window_s * US, storm_window_s * US
    b_us = SL.default_halo_bucket(max(w4, w5))
    is_req = F.col("op") == S.OP_REQUEST
    base = _pk(packets).select("src_mac", "src_ip", "ts_us", "seq", "op",
                               F.when(is_req, F.col("dst_ip")).alias("_v"))
    h = SL.with_halo(base, "src_mac", max(w4, w5), b_us)
    whole = Window.partitionBy("src_mac", "_pb")
    h = (h.withColumn("_packets", F.count(F.lit(1)).over(whole)).withColumn("_targeted", F.count("_v").over(whole))
         .where((F.col("_packets") > limit) | (F.col("_targeted") > targets)).drop("_packets", "_targeted"))
    wv = Window.partitionBy("src_mac", "_pb", "_v").orderBy("ts_us", "seq")
    end = (F.col("_pb") + 1) * F.lit(b_us)
    t = F.col("ts_us")
    x = (h.withColumn("_prev_t", F.lag("ts_us").over(wv)).withColumn("_next_t", F.lead("ts_us").over(wv)))
    present = F.col("_v").isNotNull()
    x = x.select(
        "*",
        (present & (F.col("_prev_t").isNull() | (t - F.col("_prev_t") >= F.lit(w5)))).cast("long").alias("_e5"),
        F.when(t + F.lit(w4) < end, t + F.lit(w4)).alias("_l4"),
        F.when(present & (F.col("_next_t").isNull() | (F.col("_next_t") - t >= F.lit(w5)))
               & (t + F.lit(w5) < end), t + F.lit(w5)).alias("_l5"),
        F.when((F.col("op") == S.OP_REQUEST) & (t + F.lit(w5) < end), t + F.lit(w5)).alias("_lr"),
    ).drop("_prev_t", "_next_t")
    req = (F.col("op") == S.OP_REQUEST).cast("long")
    ev = F.array(
        F.struct(t.alias("t"), F.lit(1).alias("k"), F.lit(1).cast("long").alias("a"), F.col("_e5").alias("b"),
                 req.alias("c"), F.col("_own").alias("q")),
        F.struct(F.col("_l4").alias("t"), F.lit(0).alias("k"), F.lit(-1).cast("long").alias("a"),
                 F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("c"), F.lit(False).alias("q")),
        F.struct(F.col("_l5").alias("t"), F.lit(0).alias("k"), F.lit(0).cast("long").alias("a"),
                 F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("c"), F.lit(False).alias("q")),
        F.struct(F.col("_lr").alias("t"), F.lit(0).alias("k"), F.lit(0).cast("long").alias("a"),
                 F.lit(0).cast("long").alias("b"), F.lit(-1).cast("long").alias("c"), F.lit(False).alias("q")),
    )
    e = x.withColumn("_ev", F.explode(ev)).where(F.col("_ev.t").isNotNull())
    wr = (Window.partitionBy("src_mac", "_pb").orderBy(F.col("_ev.t"), F.col("_ev.k"), F.col("seq"))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    laid = (e.withColumn("_n4", F.sum("_ev.a").over(wr)).withColumn("_u5", F.sum("_ev.b").over(wr))
            .where(F.col("_ev.k") == 1)
            .select("src_mac", "_pb", "src_ip", "ts_us", "seq", "op", "_v", F.col("_ev.q").alias("_own"), "_n4", "_u5"))
    laid = materialize(laid)
    r = laid.where("_own")
    # rule 4
    d4 = r.where(F.col("_n4") > limit)
    is_flood = F.col("_n4") > flood
    det4 = _detections(
        d4, 4, F.when(is_flood, "MAC_FLOODING").otherwise("UNUSUAL_ARP_ACTIVITY"),
        F.when(is_flood, "CRITICAL").otherwise("HIGH"),
        F.format_string(REASON_RATE, F.col("src_mac"), F.col("_n4")),
        _info(packet_count=F.col("_n4"), threshold=F.lit(limit), is_flood=is_flood,
              time_window=F.lit(rate_window_s)))
    # rule 5: members of firing requests, from the same layout
    fired = firing_members(laid.where(F.col("op") == S.OP_REQUEST), "src_mac", "_u5", w5, targets + 1,
                           ["src_ip"], max_members=10)
    fired = (fired.withColumn("_u", F.col("n_distinct")).withColumn("_r", F.col("n_rows"))
             .withColumn("_targets", F.slice(F.transform("members", lambda m: m["value"]), 1, 10)))
    det5 = _detections(
        fired, 5, F.lit("ARP_REQUEST_STORM"), F.lit("HIGH"),
        F.format_string(REASON_STORM, F.col("src_mac"), F.col("_u"), F.lit(storm_window_s)),
        _info(unique_targets=F.col("_u"), total_requests=F.col("_r"), target_ips=F.col("_targets"),
              time_window=F.lit(storm_window_s)))
    return det4, det5


# ------------------------------------------------------------ D6 / D10

RuleFn = Callable[..., DataFrame]
_REGISTRY: dict[str, tuple[int, RuleFn]] = {}


def register_rule(name: str, rule_no: int):
    """Add a rule (a function ``(packets, semantics=...) -> detections``)."""
    def deco(fn: RuleFn) -> RuleFn:
        _REGISTRY[name] = (rule_no, fn)
        return fn
    return deco


register_rule("ip_mac_change", 1)(rule_ip_mac_change)
register_rule("duplicate_ip", 2)(rule_duplicate_ip)
register_rule("gateway_change", 3)(lambda p, semantics="documented", gateways=None, changes=None:
                                   rule_gateway_change(p, gateways, semantics, changes))
register_rule("unusual_rate", 4)(rule_unusual_rate)
register_rule("request_storm", 5)(rule_request_storm)


def unregister_rule(name: str) -> None:
    """Take a user's rule out again."""
    _REGISTRY.pop(name, None)


def registered_rules() -> list[str]:
    return [n for n, _ in sorted(_REGISTRY.items(), key=lambda kv: kv[1][0])]


def run_rules(packets: DataFrame, rules=None, gateways=None, semantics: str = "documented",
              skip_failing: bool = False, normalize_macs: bool = False,
              contested: DataFrame | None = None) -> DataFrame:
    """Every rule over the same packets, detections unioned.

    ``contested``: their ``contested_packets``, if the caller has them (not with ``normalize_macs``).
    ``normalize_macs`` reads two spellings of a sender MAC (case, ``-``, white space) as one.

    A rule that fails to build (bad user rule) is skipped when
    ``skip_failing``; errors inside a running job fail the job, as a
    distributed job should.
    """
    names = rules or registered_rules()
    if normalize_macs:
        packets, contested = packets.withColumn("src_mac", normalize_mac(F.col("src_mac"))), None
    outs = []
    shared = {}
    ip_combined = semantics == "documented" and {"ip_mac_change", "duplicate_ip", "gateway_change"} <= set(names)
    if ip_combined:
        # rules 1, 2 and 3 key by sender IP: one shuffle serves all three
        d1, d2, d3 = ip_rules(packets, gateways, contested=contested)
    elif semantics == "documented" and {"ip_mac_change", "gateway_change"} <= set(names):
        # rules 1 and 3 read the same change rows: computed once
        shared["changes"] = materialize(mac_changes(packets))
    combined = semantics == "documented" and {"unusual_rate", "request_storm"} <= set(names)
    if combined:
        # rules 4 and 5 key by sender MAC: one shuffle serves both
        d4, d5 = mac_rules(packets)
    for name in names:
        _, fn = _REGISTRY[name]
        if combined and name in ("unusual_rate", "request_storm"):
            outs.append(d4 if name == "unusual_rate" else d5)
            continue
        if ip_combined and name in ("ip_mac_change", "duplicate_ip", "gateway_change"):
            outs.append({"ip_mac_change": d1, "duplicate_ip": d2, "gateway_change": d3}[name])
            continue
        try:
            if name == "gateway_change":
                outs.append(fn(packets, semantics=semantics, gateways=gateways, **shared))
            elif name == "ip_mac_change":
                outs.append(fn(packets, semantics=semantics, **shared))
            else:
                outs.append(fn(packets, semantics=semantics))
        except Exception:
            if not skip_failing:
                raise
    result = outs[0]
    for o in outs[1:]:
        result = result.unionByName(o)
    return result


# ------------------------------------------------------------ D7

def ip_mapping_state(packets: DataFrame, gateways=None, semantics: str = "documented") -> DataFrame:
    """Per IP, its current MAC and counters.

    ``documented`` counts every packet; ``observed`` leaves the first packet
    of each IP out of the counters, as the engine creates the entry with zero
    counts.  The change log itself is ``mac_changes`` (a table, not an array
    per IP, so one busy IP does not build one huge row).
    """
    _check(semantics)
    gws = list(gateways) if gateways else list(S.DEFAULT_GATEWAYS)
    pk = _pk(packets)
    order = F.struct("ts_us", "seq")
    st = pk.groupBy("src_ip").agg(
        F.max_by("src_mac", order).alias("current_mac"),
        F.min("ts_us").alias("first_seen_us"), F.max("ts_us").alias("last_seen_us"),
        F.count(F.lit(1)).alias("packet_count"),
        F.count_if(F.col("op") == S.OP_REPLY).alias("reply_count"),
        F.min_by("op", order).alias("_first_op"),
    )
    ch = mac_changes(packets).groupBy("src_ip").agg(
        F.count(F.lit(1)).alias("change_count"), F.max("ts_us").alias("last_change_us"))
    st = st.join(ch, "src_ip", "left")
    first_reply = F.coalesce(F.col("_first_op") == S.OP_REPLY, F.lit(False)).cast("long")
    if semantics == "observed":
        pc = F.col("packet_count") - 1
        rc = F.col("reply_count") - first_reply
    else:
        pc = F.col("packet_count")
        rc = F.col("reply_count")
    return st.select(
        "src_ip", "current_mac", "first_seen_us", "last_seen_us",
        pc.alias("packet_count"), rc.alias("reply_count"), (pc - rc).alias("request_count"),
        F.col("src_ip").isin(gws).alias("is_gateway"),
        F.coalesce("change_count", F.lit(0).cast("long")).alias("change_count"),
        F.col("last_change_us"),
    )


SUMMARY_SCHEMA = ("src_ip string, first_seen_us long, last_seen_us long, packet_count long, reply_count long, change_count long, "
                  "last_change_us long, first_mac string, last_mac string, first_op int")


def mapping_summary(packets: DataFrame) -> DataFrame:
    """Per IP, counts and the MACs at both ends of these packets; summaries of following stretches can be merged."""
    pk = _pk(packets)
    order = F.struct("ts_us", "seq")
    ends = pk.groupBy("src_ip").agg(
        F.min("ts_us").alias("first_seen_us"), F.max("ts_us").alias("last_seen_us"), F.count(F.lit(1)).alias("packet_count"),
        F.count_if(F.col("op") == S.OP_REPLY).alias("reply_count"), F.min_by("src_mac", order).alias("first_mac"),
        F.max_by("src_mac", order).alias("last_mac"), F.min_by("op", order).alias("first_op"))
    ch = mac_changes(packets).groupBy("src_ip").agg(F.count(F.lit(1)).alias("change_count"), F.max("ts_us").alias("last_change_us"))
    return ends.join(ch, "src_ip", "left").select(
        "src_ip", "first_seen_us", "last_seen_us", "packet_count", "reply_count",
        F.coalesce("change_count", F.lit(0).cast("long")).alias("change_count"), "last_change_us", "first_mac", "last_mac", "first_op")


def merge_summaries(*stretches: DataFrame) -> DataFrame:
    """One summary of stretches of packets that follow one another in (time, seq), the earliest first.

    An IP whose MAC differs between the end of a stretch and its next appearance changed there, when it appeared.
    Any grouping of the stretches gives the same result; one row an IP and stretch is shuffled.
    """
    rows = None
    for k, s in enumerate(stretches):
        part = s.withColumn("_k", F.lit(k))
        rows = part if rows is None else rows.unionByName(part)
    w = Window.partitionBy("src_ip").orderBy("_k")
    joint = F.lag("last_mac").over(w).isNotNull() & (F.lag("last_mac").over(w) != F.col("first_mac"))
    rows = rows.withColumn("_joint", joint).withColumn("_at", F.when(F.col("_joint"), F.col("first_seen_us")))
    return rows.groupBy("src_ip").agg(
        F.min("first_seen_us").alias("first_seen_us"), F.max("last_seen_us").alias("last_seen_us"),
        F.sum("packet_count").alias("packet_count"), F.sum("reply_count").alias("reply_count"),
        (F.sum("change_count") + F.count_if("_joint")).alias("change_count"),
        F.greatest(F.max("last_change_us"), F.max("_at")).alias("last_change_us"),
        F.min_by("first_mac", "_k").alias("first_mac"), F.max_by("last_mac", "_k").alias("last_mac"), F.min_by("first_op", "_k").alias("first_op"))


def state_from_summary(summary: DataFrame, gateways=None, semantics: str = "documented") -> DataFrame:
    """The rows of ``ip_mapping_state`` from a summary."""
    _check(semantics)
    gws = list(gateways) if gateways else list(S.DEFAULT_GATEWAYS)
    first = F.lit(1 if semantics == "observed" else 0).cast("long")
    reply = first * F.coalesce(F.col("first_op") == S.OP_REPLY, F.lit(False)).cast("long")
    pc, rc = F.col("packet_count") - first, F.col("reply_count") - reply
    return summary.select(
        "src_ip", F.col("last_mac").alias("current_mac"), "first_seen_us", "last_seen_us", pc.alias("packet_count"), rc.alias("reply_count"),
        (pc - rc).alias("request_count"), F.col("src_ip").isin(gws).alias("is_gateway"), "change_count", "last_change_us")
