"""Streaming queries (V1–V6).

Each query lands the packet view as files under the shared checkpoint
folder, runs the stream with ``availableNow`` into a parquet sink and
returns the sink read as a table.  A closing packet far in the future moves
the watermark past every real packet (end of input); it is filtered out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schema import PACKET_SCHEMA, MODEL_FEATURES
from ..session import materialize, scratch
from ..sources import fixture
from ..streaming import incremental as I
from ..streaming import stream as V
from .catalog import register
from .q_risk import _TRUST, trust_store
from .q_rules import _ALL, _ID, _base, _hist_str

CLOSING_SEQ = 10 ** 15
CLOSING_TS = 4_000_000_000 * 1_000_000


def _land(spark, sf_dir):
    base = scratch(spark, "stream")
    fixture.packets(spark, sf_dir).write.parquet(f"{base}/in/packets")
    spark.createDataFrame([(CLOSING_SEQ, CLOSING_TS, 1, "00:00:00:00:00:00", None, "0.0.0.0", None)],
                          PACKET_SCHEMA).write.parquet(f"{base}/in/closing")
    return base


def _run(stream_df, base, name):
    q = (stream_df.writeStream.format("parquet").outputMode("append")
         .option("path", f"{base}/out/{name}").option("checkpointLocation", f"{base}/ck/{name}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return stream_df.sparkSession.read.parquet(f"{base}/out/{name}")


def _src(spark, base):
    return V.read_packet_stream(spark, f"{base}/in/*", watermark="10 seconds")


@register("stream_ingest", "SELECT count(*) AS packets, min(ts_us) AS first_us, max(ts_us) AS last_us FROM packets")
def stream_ingest(spark, sf_dir):
    """V1: the file stream delivers every packet once."""
    base = _land(spark, sf_dir)
    out = _run(_src(spark, base).where(F.col("seq") < CLOSING_SEQ).select("seq", "ts_us"), base, "ingest")
    return out.agg(F.count(F.lit(1)).alias("packets"), F.min("ts_us").alias("first_us"),
                   F.max("ts_us").alias("last_us"))


_EPOCH = """
pe AS (SELECT *, ts_us - ts_us % 30000000 AS ws FROM packets),
per_mac AS (SELECT ws, src_mac, count(*) AS n FROM pe GROUP BY ws, src_mac),
mx AS (SELECT ws, max(n) AS mx FROM per_mac GROUP BY ws),
ew AS (SELECT p.ws / 1e6 AS window_start,
              count(*) FILTER (WHERE op = 1) AS arp_request_count,
              count(*) FILTER (WHERE op = 2) AS arp_reply_count,
              round(count(*) FILTER (WHERE op = 2) / greatest(count(*) FILTER (WHERE op = 1), 1), 6)
                AS reply_request_ratio,
              count(DISTINCT src_mac) AS unique_src_macs, count(DISTINCT src_ip) AS unique_src_ips,
              count(DISTINCT dst_ip) AS unique_dst_ips, count(DISTINCT (src_ip, src_mac)) AS ip_mac_pair_count,
              any_value(m.mx) AS max_packets_per_mac,
              count(DISTINCT (src_ip, src_mac)) - count(DISTINCT src_mac) AS mac_ip_change_count,
              round(greatest(count(*) FILTER (WHERE op = 2) - count(*) FILTER (WHERE op = 1), 0)
                    / greatest(count(*), 1), 6) AS unsolicited_reply_ratio
       FROM pe p JOIN mx m ON m.ws = p.ws GROUP BY p.ws)"""


@register("stream_window_features", f"SELECT window_start, {', '.join(MODEL_FEATURES)} FROM ew", _EPOCH)
def stream_window_features(spark, sf_dir):
    """V2: chained window aggregation in append mode (epoch-anchored, non-empty windows)."""
    base = _land(spark, sf_dir)
    out = _run(V.stream_window_features(_src(spark, base)), base, "features")
    return out.where(F.col("window_start") < CLOSING_TS / 1e6)


_RULE_ROWS = "SELECT rule_no, seq, event_type, severity, device_ip, device_mac FROM alld"


@register("stream_ip_rules", _RULE_ROWS + " WHERE rule_no IN (1, 2, 3)", _ALL)
def stream_ip_rules(spark, sf_dir):
    """V3 (+V5): rules 1–3 keyed by sender IP, event-time ordered through the watermark."""
    base = _land(spark, sf_dir)
    out = _run(V.stream_ip_rules(_src(spark, base)), base, "ip_rules")
    return out.where(F.col("seq") < CLOSING_SEQ).select("rule_no", "seq", "event_type", "severity",
                                                        "device_ip", "device_mac")


@register("stream_mac_rules", _RULE_ROWS + " WHERE rule_no IN (4, 5)", _ALL)
def stream_mac_rules(spark, sf_dir):
    """V4 (+V5): rules 4–5 keyed by sender MAC."""
    base = _land(spark, sf_dir)
    out = _run(V.stream_mac_rules(_src(spark, base)), base, "mac_rules")
    return out.where(F.col("seq") < CLOSING_SEQ).select("rule_no", "seq", "event_type", "severity",
                                                        "device_ip", "device_mac")


@register("stream_risk", """
SELECT sha256(concat_ws('|', CAST(w AS VARCHAR), device_mac, coalesce(device_ip, ''))) AS incident_id, device_mac, device_ip, trusted,
       CAST(round(score, 2) AS DOUBLE) AS score,
       CASE WHEN score < 25 THEN 'LOW' WHEN score < 50 THEN 'MEDIUM' WHEN score < 75 THEN 'HIGH' ELSE 'CRITICAL' END AS severity
FROM (SELECT *, CASE WHEN trusted THEN 0.9 ELSE 1.0 END * 0.6 * least(100.0,
               CASE WHEN gw THEN 35.0 ELSE 0.0 END + CASE WHEN change THEN 30.0 ELSE 0.0 END + CASE WHEN dup THEN 20.0 ELSE 0.0 END
               + CASE WHEN high THEN 10.0 ELSE 0.0 END + CASE WHEN trusted THEN 0.0 ELSE 10.0 END) AS score
      FROM (SELECT f.*, s.mac IS NOT NULL AND (s.ip IS NULL OR f.device_ip IS NULL OR s.ip = f.device_ip) AS trusted
            FROM f LEFT JOIN store s ON s.mac = lower(f.device_mac)))""", _ALL + "," + _TRUST + """,
f AS (SELECT ts_us - ts_us % 30000000 AS w, device_mac, device_ip, bool_or(event_type = 'GATEWAY_MAPPING_CHANGE') AS gw,
             bool_or(event_type IN ('IP_MAC_MAPPING_CHANGE', 'ARP_SPOOFING_ATTACK')) AS change,
             bool_or(event_type = 'DUPLICATE_IP_CLAIM') AS dup,
             bool_or(event_type IN ('UNUSUAL_ARP_ACTIVITY', 'MAC_FLOODING', 'ARP_REQUEST_STORM')) AS high FROM dets GROUP BY ALL)""")
def stream_risk(spark, sf_dir):
    """V6: detections of all five rules -> trust (stream-static) -> risk -> incidents, the last score of each."""
    base = _land(spark, sf_dir)
    store = materialize(trust_store(spark, sf_dir))         # read by every micro-batch
    for name, rules in (("mac", V.stream_mac_rules), ("ip", V.stream_ip_rules)):
        dets = rules(_src(spark, base)).where(F.col("seq") < CLOSING_SEQ)
        V.stream_risk(dets, store, f"{base}/incidents", f"{base}/ck/risk-{name}",
                      "2024-01-03T00:00:00+00:00", name=name).awaitTermination()
    return V.current_incidents(spark, f"{base}/incidents").select(
        "incident_id", "severity", "details.device_mac", "details.device_ip", F.col("details.trusted_device").alias("trusted"),
        (F.col("details.risk.score") + F.lit(0.0)).alias("score"))


def _closing(spark):
    return spark.createDataFrame([(CLOSING_SEQ, CLOSING_TS, 1, "00:00:00:00:00:00", None, "0.0.0.0", None)], PACKET_SCHEMA)


def _arrive(spark, base, name, rows, delay_seconds=10):
    """Rows arrive, in as many files as there are tasks; one trigger takes them all, and the next arrival goes on from there."""
    rows.write.parquet(f"{base}/in/{name}")
    src = V.read_packet_stream(spark, f"{base}/in/*")
    I.stream_rules(src, f"{base}/rules", f"{base}/ck", delay_seconds=delay_seconds).awaitTermination()


@register("stream_rules_record", f"""
SELECT {_ID}, * FROM (SELECT * FROM d1o UNION ALL BY NAME SELECT * FROM d2o UNION ALL BY NAME SELECT * FROM d3o
                      UNION ALL BY NAME SELECT * FROM d4o UNION ALL BY NAME SELECT * FROM d5o)""", _ALL)
def stream_rules_record(spark, sf_dir):
    """All rules over a stream in several triggers, whole detection records."""
    base = scratch(spark, "stream-record")
    p = fixture.packets(spark, sf_dir)
    lo, hi = p.agg(F.min("ts_us"), F.max("ts_us")).first()
    cuts = [lo, lo + (hi - lo) // 3, lo + 2 * (hi - lo) // 3, hi + 1]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        _arrive(spark, base, k, p.where((F.col("ts_us") >= a) & (F.col("ts_us") < b)))
    _arrive(spark, base, "closing", _closing(spark))
    d = I.detections(spark, f"{base}/rules").where(F.col("seq") < CLOSING_SEQ)
    cpm = F.col("info.claims_per_mac")
    plain = ("previous_mac", "change_number", "change_count", "claiming_mac_count", "total_claims", "packet_count", "is_flood",
             "unique_targets", "total_requests")
    return d.select(
        *_base(d), *[F.col(f"info.{c}").alias(c) for c in plain],
        _hist_str(F.col("info.change_history")).alias("history"), _hist_str(F.col("info.gateway_history")).alias("gateway_history"),
        F.array_join("info.claiming_macs", ",").alias("claiming_macs"), F.array_join("info.target_ips", ",").alias("target_ips"),
        F.array_join(F.transform(F.map_keys(cpm), lambda k: F.concat(k, F.lit(":"), F.element_at(cpm, k).cast("string"))), ",").alias("claims_per_mac"))


@register("stream_late_data", """
SELECT src_ip, count(*) AS late_rows, min(ts_us) AS first_us, max(ts_us) AS last_us
FROM packets WHERE seq % 50 = 7 AND ts_us <= (SELECT max(ts_us) - 10000000 FROM packets WHERE seq % 50 <> 7) GROUP BY src_ip""")
def stream_late_data(spark, sf_dir):
    """V5: every fiftieth packet comes after the clock has passed nearly all of their times; the ledger counts them."""
    base = scratch(spark, "stream-late")
    p = fixture.packets(spark, sf_dir)
    tardy = F.col("seq") % 50 == 7
    _arrive(spark, base, 0, p.where(~tardy))
    _arrive(spark, base, 1, p.where(tardy))
    return I.late_counts(spark, f"{base}/rules").groupBy("src_ip").agg(
        F.sum("late_rows").alias("late_rows"), F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"))
