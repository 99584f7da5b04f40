"""Queries for detection rules and detection history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alerts as H
from ..operators import rules as R
from ..sources import fixture
from ..sources import sinks as K
from .catalog import register

# ----------------------------------------------------------------- oracle CTEs

_D1 = """
lagged AS (SELECT *, lag(src_mac) OVER (PARTITION BY src_ip ORDER BY ts_us, seq) AS prev_mac FROM packets),
changes AS (SELECT * FROM lagged WHERE prev_mac IS NOT NULL AND prev_mac <> src_mac),
d1 AS (
  SELECT *,
    count(*) OVER (PARTITION BY src_ip ORDER BY ts_us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) - 1 AS earlier,
    row_number() OVER (PARTITION BY src_ip ORDER BY ts_us, seq) AS chg_no,
    list({'mac': prev_mac, 'ts': ts_us}) OVER (PARTITION BY src_ip ORDER BY ts_us, seq
                                               ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS hist
  FROM changes),
d1o AS (
  SELECT 1 AS rule_no, seq, ts_us, src_ip AS device_ip, src_mac AS device_mac,
    CASE WHEN earlier >= 3 THEN 'ARP_SPOOFING_ATTACK' ELSE 'IP_MAC_MAPPING_CHANGE' END AS event_type,
    CASE WHEN earlier >= 3 THEN 'CRITICAL' ELSE 'MEDIUM' END AS severity,
    CASE WHEN earlier >= 3 THEN 'Rapid MAC changes detected for IP ' || src_ip || ': ' || earlier || ' changes in 60s'
         ELSE 'MAC change for IP ' || src_ip || ': ' || prev_mac || ' -> ' || src_mac END AS reason,
    prev_mac AS previous_mac,
    CASE WHEN earlier < 3 THEN chg_no END AS change_number,
    CASE WHEN earlier >= 3 THEN earlier END AS change_count,
    CASE WHEN earlier >= 3 THEN nullif(array_to_string(list_transform(
         list_filter(hist, lambda e: e.ts > ts_us - 60000000), lambda e: e.mac || '@' || e.ts), ','), '') END AS history
  FROM d1)"""

_D2 = """
d2w AS (
  SELECT *, count(DISTINCT src_mac) OVER w AS n, list(src_mac) OVER w AS ms,
         row_number() OVER (PARTITION BY src_ip ORDER BY ts_us, seq) AS total_claims
  FROM packets WINDOW w AS (PARTITION BY src_ip ORDER BY ts_us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)),
d2 AS (SELECT *, list_sort(list_distinct(ms)) AS macs FROM d2w WHERE n >= 3),
d2o AS (
  SELECT 2 AS rule_no, seq, ts_us, src_ip AS device_ip, src_mac AS device_mac,
    'DUPLICATE_IP_CLAIM' AS event_type, CASE WHEN n >= 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
    'IP ' || src_ip || ' claimed by ' || n || ' different MACs: ' || array_to_string(macs[1:3], ', ') || '...' AS reason,
    n AS claiming_mac_count, total_claims, array_to_string(macs, ',') AS claiming_macs,
    array_to_string(list_transform(macs, lambda m: m || ':' || len(list_filter(ms, lambda x: x = m))), ',')
      AS claims_per_mac
  FROM d2)"""

_D3 = """
gw AS (SELECT *, lag(src_mac) OVER (PARTITION BY src_ip ORDER BY ts_us, seq) AS prev_mac
       FROM packets WHERE src_ip IN ('192.168.1.1', '10.0.0.1')),
gwc AS (SELECT *, list({'mac': src_mac, 'ts': ts_us}) OVER (PARTITION BY src_ip ORDER BY ts_us, seq
                                                            ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS gh
        FROM gw WHERE prev_mac IS NOT NULL AND prev_mac <> src_mac),
d3o AS (
  SELECT 3 AS rule_no, seq, ts_us, src_ip AS device_ip, src_mac AS device_mac,
    'GATEWAY_MAPPING_CHANGE' AS event_type, 'CRITICAL' AS severity,
    '\U0001F6A8 GATEWAY ATTACK: Gateway ' || src_ip || ' MAC changed from ' || prev_mac || ' to ' || src_mac AS reason,
    prev_mac AS previous_mac,
    array_to_string(list_transform(gh, lambda e: e.mac || '@' || e.ts), ',') AS gateway_history
  FROM gwc)"""

_D4 = """
d4w AS (SELECT *, count(*) OVER (PARTITION BY src_mac ORDER BY ts_us
                                 RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS n FROM packets),
d4o AS (
  SELECT 4 AS rule_no, seq, ts_us, src_ip AS device_ip, src_mac AS device_mac,
    CASE WHEN n > 100 THEN 'MAC_FLOODING' ELSE 'UNUSUAL_ARP_ACTIVITY' END AS event_type,
    CASE WHEN n > 100 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
    'Abnormal ARP rate from ' || src_mac || ': ' || n || ' packets in last minute' AS reason,
    n AS packet_count, n > 100 AS is_flood
  FROM d4w WHERE n > 50)"""

_D5 = """
d5w AS (SELECT *, count(DISTINCT dst_ip) OVER w AS u, count(*) OVER w AS r, list(dst_ip) OVER w AS tl
        FROM packets WHERE op = 1
        WINDOW w AS (PARTITION BY src_mac ORDER BY ts_us RANGE BETWEEN 29999999 PRECEDING AND CURRENT ROW)),
d5o AS (
  SELECT 5 AS rule_no, seq, ts_us, src_ip AS device_ip, src_mac AS device_mac,
    'ARP_REQUEST_STORM' AS event_type, 'HIGH' AS severity,
    'ARP scanning detected from ' || src_mac || ': scanning ' || u || ' unique IPs in 30s' AS reason,
    u AS unique_targets, r AS total_requests,
    array_to_string(list_sort(list_distinct(tl))[1:10], ',') AS target_ips
  FROM d5w WHERE u > 20)"""

_ALL = ",".join([_D1, _D2, _D3, _D4, _D5]) + """,
alld AS (
  SELECT rule_no, seq, ts_us, device_ip, device_mac, event_type, severity, reason FROM d1o UNION ALL
  SELECT rule_no, seq, ts_us, device_ip, device_mac, event_type, severity, reason FROM d2o UNION ALL
  SELECT rule_no, seq, ts_us, device_ip, device_mac, event_type, severity, reason FROM d3o UNION ALL
  SELECT rule_no, seq, ts_us, device_ip, device_mac, event_type, severity, reason FROM d4o UNION ALL
  SELECT rule_no, seq, ts_us, device_ip, device_mac, event_type, severity, reason FROM d5o),
dets AS (SELECT sha256(concat_ws('|', CAST(rule_no AS VARCHAR), CAST(ts_us AS VARCHAR), 
           coalesce(device_ip, ''), coalesce(device_mac, ''), CAST(seq AS VARCHAR))) AS detection_id, *
         FROM alld)"""

_ID = ("sha256(concat_ws('|', CAST(rule_no AS VARCHAR), CAST(ts_us AS VARCHAR), "
       "coalesce(device_ip, ''), coalesce(device_mac, ''), CAST(seq AS VARCHAR))) AS detection_id")
_BASE = "rule_no, seq, ts_us, device_ip, device_mac, event_type, severity, reason"


def _hist_str(col):
    return F.when(F.size(col) > 0, F.array_join(
        F.transform(col, lambda e: F.concat(e["mac"], F.lit("@"), e["ts_us"].cast("string"))), ","))


def _base(df):
    return [F.col(c) for c in ["detection_id", "rule_no", "seq", "ts_us", "device_ip", "device_mac",
                                "event_type", "severity", "reason"]]


def _pk(spark, sf_dir):
    return fixture.packets(spark, sf_dir)


@register("rule_ip_mac_change", f"SELECT {_ID}, {_BASE}, previous_mac, change_number, change_count, history FROM d1o",
          _D1)
def rule_ip_mac_change(spark, sf_dir):
    d = R.rule_ip_mac_change(_pk(spark, sf_dir))
    return d.select(*_base(d), F.col("info.previous_mac").alias("previous_mac"),
                    F.col("info.change_number").alias("change_number"),
                    F.col("info.change_count").alias("change_count"),
                    _hist_str(F.col("info.change_history")).alias("history"))


@register("rule_duplicate_ip", f"""SELECT {_ID}, {_BASE}, claiming_mac_count, total_claims, claiming_macs,
  claims_per_mac FROM d2o""", _D2)
def rule_duplicate_ip(spark, sf_dir):
    d = R.rule_duplicate_ip(_pk(spark, sf_dir))
    cpm = F.col("info.claims_per_mac")
    return d.select(*_base(d), F.col("info.claiming_mac_count").alias("claiming_mac_count"),
                    F.col("info.total_claims").alias("total_claims"),
                    F.array_join("info.claiming_macs", ",").alias("claiming_macs"),
                    F.array_join(F.transform(F.map_keys(cpm), lambda k: F.concat(
                        k, F.lit(":"), F.element_at(cpm, k).cast("string"))), ",").alias("claims_per_mac"))


@register("rule_gateway_change", f"SELECT {_ID}, {_BASE}, previous_mac, gateway_history FROM d3o", _D3)
def rule_gateway_change(spark, sf_dir):
    d = R.rule_gateway_change(_pk(spark, sf_dir))
    return d.select(*_base(d), F.col("info.previous_mac").alias("previous_mac"),
                    _hist_str(F.col("info.gateway_history")).alias("gateway_history"))


@register("rule_unusual_rate", f"SELECT {_ID}, {_BASE}, packet_count, is_flood FROM d4o", _D4)
def rule_unusual_rate(spark, sf_dir):
    d = R.rule_unusual_rate(_pk(spark, sf_dir))
    return d.select(*_base(d), F.col("info.packet_count").alias("packet_count"),
                    F.col("info.is_flood").alias("is_flood"))


@register("rule_request_storm", f"SELECT {_ID}, {_BASE}, unique_targets, total_requests, target_ips FROM d5o", _D5)
def rule_request_storm(spark, sf_dir):
    d = R.rule_request_storm(_pk(spark, sf_dir))
    return d.select(*_base(d), F.col("info.unique_targets").alias("unique_targets"),
                    F.col("info.total_requests").alias("total_requests"),
                    F.array_join("info.target_ips", ",").alias("target_ips"))


@register("rules_all", "SELECT detection_id, rule_no, seq, event_type, severity, device_ip, device_mac FROM dets",
          _ALL)
def rules_all(spark, sf_dir):
    d = R.run_rules(_pk(spark, sf_dir))
    return d.select("detection_id", "rule_no", "seq", "event_type", "severity", "device_ip", "device_mac")


def _unspecified_sender(packets, semantics="documented"):
    """A user's rule: a sender whose address is still unspecified."""
    x = packets.where(F.col("src_ip") == "0.0.0.0")
    return R.build_detections(x, 9, F.lit("SUSPICIOUS_ARP_RATE"), F.lit("LOW"),
                              F.concat(F.lit("unspecified sender address from "), F.col("src_mac")))


@register("rules_user", f"""
SELECT {_ID}, {_BASE} FROM (
  SELECT {_BASE} FROM d3o UNION ALL
  SELECT 9 AS rule_no, seq, ts_us, src_ip AS device_ip, src_mac AS device_mac, 'SUSPICIOUS_ARP_RATE' AS event_type,
         'LOW' AS severity, 'unspecified sender address from ' || src_mac AS reason
  FROM packets WHERE src_ip = '0.0.0.0') x""", _D3)
def rules_user(spark, sf_dir):
    """A user's rule is registered, run beside a built-in one, and taken out again."""
    R.register_rule("unspecified_sender", 9)(_unspecified_sender)
    try:
        d = R.run_rules(_pk(spark, sf_dir), rules=["gateway_change", "unspecified_sender"])
    finally:
        R.unregister_rule("unspecified_sender")
    return d.select(*_base(d))


_OBS = """
o4w AS (SELECT *, 2 * least(count(*) OVER (PARTITION BY src_mac ORDER BY ts_us
                                RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW), 100) AS n FROM packets),
o5w AS (SELECT *, list({'t': ts_us, 'd': dst_ip}) OVER (PARTITION BY src_mac ORDER BY ts_us, seq
                                ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS l FROM packets WHERE op = 1),
o5 AS (SELECT *, list_filter(l, lambda e: e.t > ts_us - 30000000) AS rl FROM o5w),
o5u AS (SELECT *, len(list_distinct(list_transform(rl, lambda e: e.d))) AS u FROM o5)"""


@register("rules_observed", """
SELECT 4 AS rule_no, seq, CASE WHEN n > 100 THEN 'MAC_FLOODING' ELSE 'UNUSUAL_ARP_ACTIVITY' END AS event_type,
       n AS packet_count, CAST(NULL AS BIGINT) AS unique_targets, CAST(NULL AS BIGINT) AS total_requests
FROM o4w WHERE n > 50
UNION ALL
SELECT 5 AS rule_no, seq, 'ARP_REQUEST_STORM' AS event_type, CAST(NULL AS BIGINT) AS packet_count,
       u AS unique_targets, 2 * len(rl) AS total_requests
FROM o5u WHERE u > 20
UNION ALL
SELECT 2 AS rule_no, seq, 'DUPLICATE_IP_CLAIM' AS event_type, CAST(NULL AS BIGINT) AS packet_count,
       CAST(NULL AS BIGINT) AS unique_targets, CAST(NULL AS BIGINT) AS total_requests
FROM d2w WHERE n >= 3""", _OBS + "," + _D2)
def rules_observed(spark, sf_dir):
    d = R.run_rules(_pk(spark, sf_dir), semantics="observed")
    return d.select("rule_no", "seq", "event_type", F.col("info.packet_count").alias("packet_count"),
                    F.col("info.unique_targets").alias("unique_targets"),
                    F.col("info.total_requests").alias("total_requests"))


@register("ip_mapping_state", """
SELECT p.src_ip, arg_max(src_mac, (ts_us, seq)) AS current_mac, min(ts_us) AS first_seen_us,
       max(ts_us) AS last_seen_us, count(*) AS packet_count,
       count(*) FILTER (WHERE op = 2) AS reply_count, count(*) FILTER (WHERE op IS DISTINCT FROM 2) AS request_count,
       p.src_ip IN ('192.168.1.1', '10.0.0.1') AS is_gateway,
       coalesce(any_value(c.n), 0) AS change_count, any_value(c.last_us) AS last_change_us
FROM packets p LEFT JOIN (SELECT src_ip, count(*) AS n, max(ts_us) AS last_us FROM changes GROUP BY src_ip) c
  ON c.src_ip = p.src_ip
GROUP BY p.src_ip""", """
lagged AS (SELECT *, lag(src_mac) OVER (PARTITION BY src_ip ORDER BY ts_us, seq) AS prev_mac FROM packets),
changes AS (SELECT * FROM lagged WHERE prev_mac IS NOT NULL AND prev_mac <> src_mac)""")
def ip_mapping_state(spark, sf_dir):
    return R.ip_mapping_state(_pk(spark, sf_dir))


@register("ip_mapping_incremental", """
SELECT p.src_ip, arg_max(src_mac, (ts_us, seq)) AS current_mac, min(ts_us) AS first_seen_us,
       max(ts_us) AS last_seen_us, count(*) AS packet_count,
       count(*) FILTER (WHERE op = 2) AS reply_count, count(*) FILTER (WHERE op IS DISTINCT FROM 2) AS request_count,
       p.src_ip IN ('192.168.1.1', '10.0.0.1') AS is_gateway,
       coalesce(any_value(c.n), 0) AS change_count, any_value(c.last_us) AS last_change_us
FROM packets p LEFT JOIN (SELECT src_ip, count(*) AS n, max(ts_us) AS last_us FROM changes GROUP BY src_ip) c
  ON c.src_ip = p.src_ip
GROUP BY p.src_ip""", """
lagged AS (SELECT *, lag(src_mac) OVER (PARTITION BY src_ip ORDER BY ts_us, seq) AS prev_mac FROM packets),
changes AS (SELECT * FROM lagged WHERE prev_mac IS NOT NULL AND prev_mac <> src_mac)""")
def ip_mapping_incremental(spark, sf_dir):
    """The state of the first two thirds is saved, and merged with the summary of the rest."""
    from ..session import scratch
    p = _pk(spark, sf_dir)
    lo, hi = p.agg(F.min("ts_us"), F.max("ts_us")).first()
    cuts = [lo + (hi - lo) // 3, lo + 2 * (hi - lo) // 3]
    parts = [p.where(F.col("ts_us") < cuts[0]), p.where((F.col("ts_us") >= cuts[0]) & (F.col("ts_us") < cuts[1])), p.where(F.col("ts_us") >= cuts[1])]
    path = scratch(spark, "mapping-state")
    for part in parts:
        known = K.load_state(spark, path, spark.createDataFrame([], R.SUMMARY_SCHEMA).schema)
        K.save_state(R.merge_summaries(known, R.mapping_summary(part)), path)
    return R.state_from_summary(K.load_state(spark, path, spark.createDataFrame([], R.SUMMARY_SCHEMA).schema))


@register("mac_change_log", "SELECT src_ip, seq, ts_us, prev_mac AS previous_mac, src_mac AS new_mac FROM changes", """
lagged AS (SELECT *, lag(src_mac) OVER (PARTITION BY src_ip ORDER BY ts_us, seq) AS prev_mac FROM packets),
changes AS (SELECT * FROM lagged WHERE prev_mac IS NOT NULL AND prev_mac <> src_mac)""")
def mac_change_log(spark, sf_dir):
    ch = R.mac_changes(_pk(spark, sf_dir))
    return ch.select("src_ip", "seq", "ts_us", F.col("prev_src_mac").alias("previous_mac"),
                     F.col("src_mac").alias("new_mac"))


# ----------------------------------------------------------------- history (H1–H5)

def _dets(spark, sf_dir):
    return R.run_rules(_pk(spark, sf_dir))


@register("detections_filtered", """
SELECT detection_id, seq, event_type, severity FROM dets
WHERE severity = 'CRITICAL' AND event_type = 'MAC_FLOODING'
ORDER BY ts_us DESC, seq DESC, rule_no DESC LIMIT 50""", _ALL)
def detections_filtered(spark, sf_dir):
    d = H.filter_detections(_dets(spark, sf_dir), severity="CRITICAL", event_type="MAC_FLOODING", limit=50)
    return d.select("detection_id", "seq", "event_type", "severity")


@register("detections_recent", """
SELECT detection_id, seq, event_type FROM dets
WHERE ts_us > (SELECT max(ts_us) FROM packets) - 300000000""", _ALL)
def detections_recent(spark, sf_dir):
    p = _pk(spark, sf_dir)
    as_of = p.agg(F.max("ts_us").alias("as_of"))
    d = H.recent_detections(R.run_rules(p), as_of, window_s=300)
    return d.select("detection_id", "seq", "event_type")


@register("detection_stats", """
SELECT 'total' AS dimension, 'all' AS value, count(*) AS detections FROM dets
UNION ALL SELECT 'severity', severity, count(*) FROM dets GROUP BY severity
UNION ALL SELECT 'event_type', event_type, count(*) FROM dets GROUP BY event_type""", _ALL)
def detection_stats(spark, sf_dir):
    return H.detection_statistics(_dets(spark, sf_dir))


@register("detection_recent5", """
SELECT detection_id, seq FROM dets ORDER BY ts_us DESC, seq DESC, rule_no DESC LIMIT 5""", _ALL)
def detection_recent5(spark, sf_dir):
    return H.latest_detections(_dets(spark, sf_dir), 5).select("detection_id", "seq")


@register("alert_routing", """
SELECT detection_id, severity IN ('CRITICAL', 'HIGH', 'MEDIUM') AS to_console,
       severity IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW') AS to_log,
       CASE WHEN severity = 'CRITICAL' THEN 'CRITICAL' ELSE 'WARNING' END AS log_level FROM dets""", _ALL)
def alert_routing(spark, sf_dir):
    return H.alert_routing(_dets(spark, sf_dir)).select("detection_id", "to_console", "to_log", "log_level")


@register("detection_json")  # JSON text formatting differs between engines: rows-only + pytest
def detection_json(spark, sf_dir):
    return H.detection_json(_dets(spark, sf_dir))


@register("detection_json_fields", """
SELECT detection_id, event_type, severity, device_ip AS ip, device_mac AS mac, ts_us FROM dets""", _ALL)
def detection_json_fields(spark, sf_dir):
    """H5: the JSON documents, parsed again field by field."""
    doc = F.from_json("json", "detection_id string, event_type string, severity string, timestamp string, "
                              "affected_device struct<ip:string,mac:string>")
    d = H.detection_json(_dets(spark, sf_dir)).select(doc.alias("d"))
    return d.select("d.detection_id", "d.event_type", "d.severity", "d.affected_device.ip", "d.affected_device.mac",
                    F.unix_micros(F.to_timestamp("d.timestamp")).alias("ts_us"))


@register("history_clear", """
SELECT 'before' AS moment, count(*) AS detections FROM dets UNION ALL SELECT 'after', 0""", _ALL)
def history_clear(spark, sf_dir):
    """H6: the history before and after it is cleared."""
    dets = _dets(spark, sf_dir)
    size = lambda df, name: df.agg(F.lit(name).alias("moment"), F.count(F.lit(1)).alias("detections"))
    return size(dets, "before").union(size(H.clear_history(dets), "after"))
