"""Queries that round-trip data through sinks and readers.

They write under the shared folder named by ``spark.checkpoint.dir`` (a
fresh sub-folder per call) and read the result back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forest as M
from ..operators import incidents as I
from ..operators import rules as R
from ..operators import trust as T
from ..schema import MODEL_FEATURES
from ..session import materialize, scratch
from ..sources import fixture
from ..sources import packets as S
from ..sources import sinks as K
from .catalog import register
from .q_features import _BINNED, FEATURE_LIST
from .q_ml import _CONF, _chain
from .q_risk import _FINDINGS, _TRUST, _incidents, trust_store
from .q_rules import _ALL

_PKT = "seq, ts_us, op, src_mac, dst_mac, src_ip, dst_ip"


@register("csv_roundtrip", f"SELECT {_PKT} FROM packets")
def csv_roundtrip(spark, sf_dir):
    """S5 + S1: packets written as ML-dialect CSV, read back through the contract."""
    p = fixture.packets(spark, sf_dir)
    path = scratch(spark, "packets-csv")
    K.write_csv(p.select((F.col("ts_us") / F.lit(1e6)).alias("timestamp"), "op", "src_mac", "dst_mac",
                         "src_ip", "dst_ip", F.col("seq").alias("pkt_seq")), path)
    back = S.read_packet_csv(spark, path, keep=["pkt_seq"])
    # the reader numbers rows by position; the written packet id is carried through
    return back.select(F.col("pkt_seq").cast("long").alias("seq"), "ts_us", "op", "src_mac", "dst_mac",
                       "src_ip", "dst_ip")


@register("detection_report", """
SELECT count(*) AS total_alerts, count(*) AS total_detections FROM dets""",
          _ALL)
def detection_report(spark, sf_dir):
    """The one-row report (statistics maps checked in pytest)."""
    rep = K.detection_report(R.run_rules(fixture.packets(spark, sf_dir)), "2024-01-03T00:00:00+00:00")
    return rep.select("total_alerts", F.col("statistics.total_detections").alias("total_detections"))


@register("incident_roundtrip", """
SELECT sha256(concat_ws('|', CAST(CAST(round(window_start * 1000000) AS BIGINT) AS VARCHAR), device_mac,
                        coalesce(device_ip, ''))) AS incident_id, level AS severity, 'ARP_ANOMALY' AS incident_type,
       device_mac, score, rule_findings
FROM risk, (VALUES (1), (2)) twice(n)""", _FINDINGS)
def incident_roundtrip(spark, sf_dir):
    """Incidents appended twice as JSON Lines, read back: two rows for each."""
    inc = materialize(_incidents(spark, sf_dir))        # appended twice, computed once
    path = scratch(spark, "incidents")
    I.append_incidents(inc, path)
    I.append_incidents(inc, path)
    return I.read_incidents(spark, path).select(
        "incident_id", "severity", "incident_type", F.col("details.device_mac").alias("device_mac"),
        (F.col("details.risk.score") + F.lit(0.0)).alias("score"),
        F.array_join("details.risk.rule_findings", ", ").alias("rule_findings"))


@register("state_load", "SELECT mac, ip, label, added_at FROM store", _TRUST)
def state_load(spark, sf_dir):
    """S11 + T3 list: the trust table saved, loaded under its schema and listed."""
    path = scratch(spark, "trust")
    K.save_state(trust_store(spark, sf_dir), path)
    return T.list_devices(K.load_state(spark, path, T.TRUST_SCHEMA))


@register("artifact_roundtrip")
def artifact_roundtrip(spark, sf_dir):
    """Fitted forest saved as parquet tables and loaded; scores must agree."""
    from . import service
    feats, params, model, preds = service.ml_chain(fixture.packets(spark, sf_dir))
    path = scratch(spark, "model")
    M.save_model(model, spark, path)
    again = M.predict(M.load_model(spark, path), feats, scaler=params)
    return again.select("window_start", F.col("anomaly_score").alias("anomaly_score_loaded")).join(
        preds.select("window_start", "anomaly_score"), "window_start")


@register("metrics_sink", """
SELECT 'supervised' AS evaluation_mode, n AS total_samples, tn AS true_negative, fp AS false_positive,
       fn AS false_negative, tp AS true_positive, round(p1, 4) AS precision, round(r1, 4) AS recall,
       round(f1, 4) AS f1_score, round(fp / greatest(fp + tn, 1), 4) AS false_positive_rate FROM m2""", _CONF)
def metrics_sink(spark, sf_dir):
    """Evaluation metrics written as one JSON document and read back."""
    from ..operators import evaluate as E
    p = fixture.packets_with_label(spark, sf_dir)
    m = E.evaluate(E.rule_predictions(p, R.run_rules(p)), label_coding="zero_one")
    path = scratch(spark, "metrics")
    K.write_metrics(m, path)
    return spark.read.json(path)


@register("prediction_json_fields", f"""
SELECT window_start, 'IsolationForest' AS model_type, true AS coded_alike, true AS scored, {FEATURE_LIST} FROM wf""", _BINNED)
def prediction_json_fields(spark, sf_dir):
    """The written records, read again as JSON text and parsed field by field."""
    _, _, _, preds = _chain(spark, sf_dir)
    path = scratch(spark, "prediction-json")
    K.write_prediction_json(preds, path)
    doc = F.from_json("value", "window_start double, anomaly_prediction int, anomaly_score double, is_anomaly boolean, "
                               "model_type string, features map<string,double>")
    d = spark.read.text(path).select(doc.alias("d"))
    feature = lambda c: F.element_at("d.features", c)
    return d.select("d.window_start", "d.model_type",
                    (F.when(F.col("d.is_anomaly"), -1).otherwise(1) == F.col("d.anomaly_prediction")).alias("coded_alike"),
                    F.col("d.anomaly_score").isNotNull().alias("scored"),
                    *[feature(c).cast("double" if c.endswith("ratio") else "long").alias(c) for c in MODEL_FEATURES])
