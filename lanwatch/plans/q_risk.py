"""Queries for risk, trust, incidents and responses."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.mac import normalize_mac
from ..functions.risk import assess
from ..operators import features as W
from ..operators import incidents as I
from ..operators import responses as Q
from ..operators import rules as R
from ..operators import trust as T
from ..operators.findings import FLAG_NAMES, as_maps, event_key, findings_from_detections
from ..sources import fixture
from . import service
from .catalog import register
from .q_features import _BINNED
from .q_rules import _ALL

ADDED_1 = "2024-01-01T00:00:00+00:00"
ADDED_2 = "2024-01-02T00:00:00+00:00"
CREATED = "2024-01-03T00:00:00+00:00"
GATEWAY_IP = "192.168.1.1"


# ----------------------------------------------------------------- R7

@register("normalize_mac", """
SELECT seq, lower(replace(trim(' ' || upper(replace(src_mac, ':', '-')) || ' '), '-', ':')) AS mac FROM packets""")
def normalize_mac_q(spark, sf_dir):
    p = fixture.packets(spark, sf_dir)
    raw = F.concat(F.lit(" "), F.upper(F.regexp_replace("src_mac", ":", "-")), F.lit(" "))
    return p.select("seq", normalize_mac(raw).alias("mac"))


# ----------------------------------------------------------------- T1–T4
# Trust list derived from the data: every sender (IP, MAC) pair whose IP was
# only ever seen with that one MAC is a known device (first batch); the MACs
# seen on the gateway IP are added without an IP (second batch).

_TRUST = """
stable AS (SELECT src_ip FROM packets WHERE src_ip <> '0.0.0.0' GROUP BY src_ip HAVING count(DISTINCT src_mac) = 1),
b1 AS (SELECT lower(replace(upper(replace(p.src_mac, ':', '-')), '-', ':')) AS mac, p.src_ip AS ip,
              'host ' || p.src_ip AS label, min(p.seq) AS seq
       FROM packets p JOIN stable s ON s.src_ip = p.src_ip GROUP BY p.src_mac, p.src_ip),
s1 AS (SELECT mac, arg_max(ip, seq) AS ip, arg_max(label, seq) AS label, '""" + ADDED_1 + """' AS added_at
       FROM b1 GROUP BY mac),
b2 AS (SELECT DISTINCT src_mac AS mac FROM packets WHERE src_ip = '""" + GATEWAY_IP + """'),
store AS (SELECT coalesce(s1.mac, b2.mac) AS mac, s1.ip AS ip, coalesce(s1.label, '') AS label,
                 coalesce(s1.added_at, '""" + ADDED_2 + """') AS added_at
          FROM s1 FULL OUTER JOIN b2 ON s1.mac = b2.mac)"""


def _batch1(p):
    # one scan: the distinct pairs of every address, of which one with a single MAC is kept
    pairs = p.where(F.col("src_ip") != "0.0.0.0").groupBy("src_mac", "src_ip").agg(F.min("seq").alias("seq"))
    macs = F.count("src_mac").over(Window.partitionBy("src_ip"))
    return (pairs.withColumn("_m", macs).where(F.col("_m") == 1)
            .select(F.upper(F.regexp_replace("src_mac", ":", "-")).alias("mac"), F.col("src_ip").alias("ip"),
                    F.concat(F.lit("host "), F.col("src_ip")).alias("label"), "seq"))


def trust_store(spark, sf_dir):
    p = fixture.packets(spark, sf_dir)
    store = T.upsert(T.empty_store(spark), _batch1(p), ADDED_1)
    b2 = (p.where(F.col("src_ip") == GATEWAY_IP).select("src_mac").distinct()
          .select(F.col("src_mac").alias("mac"), F.lit(None).cast("string").alias("ip"),
                  F.lit("").alias("label"), F.lit(0).cast("long").alias("seq")))
    return T.upsert(store, b2, ADDED_2)


@register("trust_upsert", "SELECT mac, ip, label, added_at FROM store", _TRUST)
def trust_upsert(spark, sf_dir):
    return trust_store(spark, sf_dir)


@register("trust_remove", """
SELECT mac, ip, label, added_at FROM store
WHERE mac NOT IN (SELECT src_mac FROM packets WHERE src_ip IN (
  SELECT src_ip FROM packets WHERE src_ip <> '0.0.0.0' GROUP BY src_ip HAVING count(DISTINCT src_mac) > 1))""", _TRUST)
def trust_remove(spark, sf_dir):
    p = fixture.packets(spark, sf_dir)
    conflict_ips = (p.where(F.col("src_ip") != "0.0.0.0").groupBy("src_ip")
                    .agg(F.count_distinct("src_mac").alias("_m")).where(F.col("_m") > 1))
    macs = p.join(conflict_ips, "src_ip", "left_semi").select(F.col("src_mac").alias("mac"))
    remaining, _ = T.remove(trust_store(spark, sf_dir), macs)
    return remaining


@register("trust_get", "SELECT mac, ip, label, added_at FROM store WHERE mac = '02:00:00:00:00:fe'", _TRUST)
def trust_get(spark, sf_dir):
    return T.get_device(trust_store(spark, sf_dir), " 02-00-00-00-00-FE ")


@register("trust_lookup", """
SELECT p.seq, s.mac IS NOT NULL AND (s.ip IS NULL OR p.src_ip IS NULL OR s.ip = p.src_ip) AS trusted
FROM packets p LEFT JOIN store s ON s.mac = lower(p.src_mac)""", _TRUST)
def trust_lookup(spark, sf_dir):
    p = fixture.packets(spark, sf_dir)
    out = T.trusted_flag(p, trust_store(spark, sf_dir), mac_col="src_mac", ip_col="src_ip")
    return out.select("seq", "trusted")


# ----------------------------------------------------------------- R8, R1–R6

_FINDINGS = _BINNED + "," + _ALL + "," + _TRUST + """,
fd AS (SELECT (d.ts_us - b.lo) // 30000000 AS bin, device_mac, device_ip,
              bool_or(event_type = 'GATEWAY_MAPPING_CHANGE') AS gateway_mapping_change,
              bool_or(event_type IN ('IP_MAC_MAPPING_CHANGE', 'ARP_SPOOFING_ATTACK')) AS mac_ip_change,
              bool_or(event_type = 'DUPLICATE_IP_CLAIM') AS duplicate_ip,
              bool_or(event_type IN ('UNUSUAL_ARP_ACTIVITY', 'MAC_FLOODING', 'ARP_REQUEST_STORM')) AS high_arp_rate
       FROM dets d, b GROUP BY 1, 2, 3),
cf AS (SELECT (ts_us - lo) // 30000000 AS bin, src_ip FROM packets, b WHERE src_ip <> '0.0.0.0'
       GROUP BY 1, 2 HAVING count(DISTINCT src_mac) > 1),
fnd AS (SELECT fd.*, cf.src_ip IS NOT NULL AS ip_mac_conflict, wf.unsolicited_reply_ratio AS unsolicited_reply,
               wf.window_start
        FROM fd LEFT JOIN cf ON cf.bin = fd.bin AND cf.src_ip = fd.device_ip LEFT JOIN wf ON wf.bin = fd.bin),
ev AS (SELECT f.*, s.mac IS NOT NULL AND (s.ip IS NULL OR f.device_ip IS NULL OR s.ip = f.device_ip) AS trusted
       FROM fnd f LEFT JOIN store s ON s.mac = lower(f.device_mac)),
rs AS (SELECT *,
         least(100.0, greatest(0.0,
           CASE WHEN mac_ip_change THEN 30.0 ELSE 0.0 END + CASE WHEN ip_mac_conflict THEN 25.0 ELSE 0.0 END
         + CASE WHEN unsolicited_reply > 0 THEN 20.0 * least(1.0, greatest(0.0, unsolicited_reply)) ELSE 0.0 END
         + CASE WHEN duplicate_ip THEN 20.0 ELSE 0.0 END + CASE WHEN high_arp_rate THEN 10.0 ELSE 0.0 END
         + CASE WHEN NOT trusted THEN 10.0 ELSE 0.0 END + CASE WHEN gateway_mapping_change THEN 35.0 ELSE 0.0 END))
         AS rule_score,
         list_filter([CASE WHEN mac_ip_change THEN 'mac_ip_change' END,
                      CASE WHEN ip_mac_conflict THEN 'ip_mac_conflict' END,
                      CASE WHEN unsolicited_reply > 0 THEN printf('unsolicited_reply=%.2f', unsolicited_reply) END,
                      CASE WHEN duplicate_ip THEN 'duplicate_ip' END,
                      CASE WHEN high_arp_rate THEN 'high_arp_rate' END,
                      CASE WHEN NOT trusted THEN 'unknown_device' END,
                      CASE WHEN gateway_mapping_change THEN 'gateway_mapping_change' END], lambda x: x IS NOT NULL)
         AS active
       FROM ev),
sc AS (SELECT *, CASE WHEN bin % 5 <> 4 THEN (bin % 7 - 4) / 8.0 END AS a, bin % 3 = 1 AS flagged FROM rs),
ms AS (SELECT *, CASE WHEN a IS NULL THEN CASE WHEN flagged THEN 100.0 ELSE 0.0 END
                      WHEN a >= 0 AND NOT flagged THEN 0.0
                      ELSE least(100.0, greatest(0.0, CASE WHEN flagged THEN greatest(-a / 0.5 * 100, 50.0) ELSE -a / 0.5 * 100 END))
                 END AS ml FROM sc),
cmb AS (SELECT *, least(100.0, greatest(0.0, (0.6 * rule_score + 0.4 * ml + CASE WHEN len(active) > 0 AND flagged THEN 10.0 ELSE 0.0 END)
                                        * CASE WHEN trusted THEN 0.9 ELSE 1.0 END)) AS combined FROM ms),
risk AS (SELECT bin, window_start, device_mac, device_ip, trusted,
           round(combined, 2) + 0.0 AS score,
           CASE WHEN combined < 25 THEN 'LOW' WHEN combined < 50 THEN 'MEDIUM' WHEN combined < 75 THEN 'HIGH'
                ELSE 'CRITICAL' END AS level,
           round(rule_score, 2) + 0.0 AS rule_score, CAST(round(ml, 2) AS DOUBLE) AS ml_score,
           array_to_string(active, ', ') AS rule_findings, flagged AS ml_anomaly,
           CASE WHEN len(active) = 0 AND NOT flagged AND a IS NULL AND NOT trusted THEN 'No significant detection evidence'
                ELSE concat_ws('; ', CASE WHEN len(active) > 0 THEN 'Rule findings: ' || array_to_string(active, ', ') END,
                                     CASE WHEN flagged THEN 'ML model marked the traffic window anomalous' WHEN a IS NOT NULL THEN printf('ML anomaly score=%.4f', a) END,
                                     CASE WHEN trusted THEN 'Trusted-device adjustment applied' END) END AS explanation
         FROM cmb)"""


def _findings(spark, sf_dir):
    p = fixture.packets(spark, sf_dir)
    bounds = W.time_bounds(p)
    wf = W.engineer_features(p, include_bin=True, bounds=bounds)
    contested = R.contested_packets(p)
    return findings_from_detections(R.run_rules(p, contested=contested), contested, bounds[0], wf)


@register("findings_from_detections", f"""
SELECT bin, window_start, device_mac, device_ip, {", ".join(FLAG_NAMES)}, unsolicited_reply FROM fnd""", _FINDINGS)
def findings_q(spark, sf_dir):
    return _findings(spark, sf_dir)


def _risk_events(spark, sf_dir):
    f = T.trusted_flag(_findings(spark, sf_dir), trust_store(spark, sf_dir))
    f = as_maps(f, {"unknown_device": ~F.col("trusted")})
    # anomaly evidence made from the window's number: none, inliers, outliers, flagged ones without a score
    score = F.when(F.col("bin") % 5 != 4, (F.col("bin") % 7 - 4) / F.lit(8.0))
    return f.withColumn("risk", assess(F.col("flags"), F.col("confidence"), score,
                                       F.col("bin") % 3 == 1, F.col("trusted")))


@register("risk_assessment", """
SELECT bin, device_mac, device_ip, score, level, rule_score, ml_score, rule_findings, ml_anomaly, explanation
FROM risk""", _FINDINGS)
def risk_assessment(spark, sf_dir):
    ev = _risk_events(spark, sf_dir)
    return ev.select("bin", "device_mac", "device_ip",
                     (F.col("risk.score") + F.lit(0.0)).alias("score"), F.col("risk.level").alias("level"),
                     (F.col("risk.rule_score") + F.lit(0.0)).alias("rule_score"),
                     (F.col("risk.ml_score") + F.lit(0.0)).alias("ml_score"),
                     F.array_join("risk.rule_findings", ", ").alias("rule_findings"),
                     F.col("risk.ml_anomaly").alias("ml_anomaly"), F.col("risk.explanation").alias("explanation"))


# ----------------------------------------------------------------- I1, Q1–Q4

def _incidents(spark, sf_dir):
    ev = _risk_events(spark, sf_dir).withColumn("event_key", event_key())
    return I.build_incidents(ev, CREATED, ["event_key"])


_REQ = _FINDINGS + """,
inc AS (SELECT sha256(concat_ws('|', CAST(CAST(round(window_start * 1000000) AS BIGINT) AS VARCHAR), device_mac, coalesce(device_ip, ''))) AS incident_id, *
        FROM risk),
req AS (SELECT 'resp-' || CAST(row_number() OVER (ORDER BY incident_id) AS VARCHAR) AS request_id, incident_id,
               'ISOLATE_DEVICE' AS action, device_mac AS target_mac, device_ip AS target_ip,
               explanation AS reason, 'PENDING' AS status, '""" + CREATED + """' AS created_at
        FROM inc WHERE level IN ('HIGH', 'CRITICAL'))"""


@register("incident_build", """
SELECT sha256(concat_ws('|', CAST(CAST(round(window_start * 1000000) AS BIGINT) AS VARCHAR), device_mac, coalesce(device_ip, ''))) AS incident_id,
       'ARP_ANOMALY' AS incident_type, level AS severity, device_mac, device_ip, trusted AS trusted_device,
       score FROM risk""", _FINDINGS)
def incident_build(spark, sf_dir):
    inc = _incidents(spark, sf_dir)
    return inc.select("incident_id", "incident_type", "severity", F.col("details.device_mac").alias("device_mac"),
                      F.col("details.device_ip").alias("device_ip"),
                      F.col("details.trusted_device").alias("trusted_device"),
                      (F.col("details.risk.score") + F.lit(0.0)).alias("score"))


def _requests(spark, sf_dir):
    return Q.create_requests(_incidents(spark, sf_dir), CREATED)


@register("response_requests", """
SELECT request_id, incident_id, action, target_mac, target_ip, reason, status, created_at FROM req""", _REQ)
def response_requests(spark, sf_dir):
    r = _requests(spark, sf_dir)
    return r.select("request_id", "incident_id", "action", F.col("target.mac").alias("target_mac"),
                    F.col("target.ip").alias("target_ip"), "reason", "status", "created_at")


@register("response_workflow", """
SELECT request_id, 'EXECUTED' AS status, 'admin' AS approved_by, '2024-01-04T00:00:00+00:00' AS executed_at,
       'DRY_RUN: ISOLATE_DEVICE for {''mac'': ''' || target_mac || ''', ''ip'': '
         || CASE WHEN target_ip IS NULL THEN 'None' ELSE '''' || target_ip || '''' END || '}' AS result,
       1 AS errors
FROM req""", _REQ)
def response_workflow(spark, sf_dir):
    reqs = _requests(spark, sf_dir)
    # Administrator log: an early execute (refused), then approve, then execute.
    cmds = reqs.select("request_id", F.explode(F.array(
        F.struct(F.lit(1).alias("order"), F.lit("execute").alias("command"), F.lit(None).cast("string").alias("admin"),
                 F.lit("2024-01-03T12:00:00+00:00").alias("at")),
        F.struct(F.lit(2).alias("order"), F.lit("approve").alias("command"), F.lit("admin").alias("admin"),
                 F.lit("2024-01-03T13:00:00+00:00").alias("at")),
        F.struct(F.lit(3).alias("order"), F.lit("execute").alias("command"), F.lit(None).cast("string").alias("admin"),
                 F.lit("2024-01-04T00:00:00+00:00").alias("at")))).alias("c")).select("request_id", "c.*")
    state, errors = Q.apply_commands(reqs, cmds)
    n_err = errors.groupBy("request_id").agg(F.count(F.lit(1)).cast("int").alias("errors"))
    return state.join(n_err, "request_id", "left").select(
        "request_id", "status", "approved_by", "executed_at", "result",
        F.coalesce("errors", F.lit(0)).alias("errors"))


@register("response_rejects", """
SELECT request_id, 'REJECTED' AS status, 'admin' AS approved_by, 2 AS errors,
       'Unsupported defensive action: SHUT_DOWN' AS unsupported FROM req""", _REQ)
def response_rejects(spark, sf_dir):
    """Q2/Q3: an action outside the list is refused; a rejected request can't be approved or executed."""
    reqs = _requests(spark, sf_dir)
    _, refused = Q.validate_actions(reqs.withColumn("action", F.lit("shut_down")))
    at = F.lit("2024-01-03T12:00:00+00:00").alias("at")
    cmds = reqs.select("request_id", F.explode(F.array(*[
        F.struct(F.lit(k).alias("order"), F.lit(c).alias("command"), F.lit("admin").alias("admin"), at)
        for k, c in enumerate(("reject", "approve", "execute"), 1)])).alias("c")).select("request_id", "c.*")
    state, errors = Q.apply_commands(reqs, cmds)
    n_err = errors.groupBy("request_id").agg(F.count(F.lit(1)).cast("int").alias("errors"))
    return (state.join(n_err, "request_id").join(refused.select("request_id", F.col("error").alias("unsupported")), "request_id")
            .select("request_id", "status", "approved_by", "errors", "unsupported"))


@register("end_to_end_check", """
SELECT count(*) AS incidents, count(*) AS distinct_ids, count(*) AS levels_follow_scores FROM fnd""", _FINDINGS)
def end_to_end_check(spark, sf_dir):
    """X1 by its properties: one incident for each finding, ids distinct, levels by score."""
    p = fixture.packets(spark, sf_dir)
    _, incidents, _ = service.end_to_end(p, trust_store(spark, sf_dir), CREATED)
    score = F.col("details.risk.score")
    level = F.when(score < 25, "LOW").when(score < 50, "MEDIUM").when(score < 75, "HIGH").otherwise("CRITICAL")
    return incidents.agg(F.count(F.lit(1)).alias("incidents"), F.count_distinct("incident_id").alias("distinct_ids"),
                         F.count_if(F.col("severity") == level).alias("levels_follow_scores"))


# ----------------------------------------------------------------- X1 (rows-only: forest inside)

@register("end_to_end")
def end_to_end(spark, sf_dir):
    p = fixture.packets(spark, sf_dir)
    assessed, incidents, requests = service.end_to_end(p, trust_store(spark, sf_dir), CREATED)
    return incidents.select("incident_id", "severity", F.col("details.device_mac").alias("device_mac"),
                            F.col("details.risk.score").alias("score"),
                            F.col("details.risk.explanation").alias("explanation"))
