import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanwatch.functions.mac import normalize_mac
from lanwatch.functions.risk import assess
from lanwatch.operators import responses as Q
from lanwatch.operators import trust as TR

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("flags", T.MapType(T.StringType(), T.BooleanType())),
    T.StructField("confidence", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("score", T.DoubleType()),
    T.StructField("flagged", T.BooleanType()),
    T.StructField("trusted", T.BooleanType()),
])

# (findings flags, confidences, anomaly score, is_anomaly, trusted) -> (rule, ml, score, level)
GOLDEN = [
    ({}, {}, 0.10, False, False, 0.0, 0.0, 0.0, "LOW"),
    ({"mac_ip_change": True, "ip_mac_conflict": True, "unsolicited_reply": True}, {}, -0.6, True, False,
     75.0, 100.0, 95.0, "CRITICAL"),
    ({"gateway_mapping_change": True}, {}, -0.5, True, True, 35.0, 100.0, 63.9, "HIGH"),
    ({"mac_ip_change": True, "high_arp_rate": True}, {"unsolicited_reply": 0.8}, -0.22, True, False,
     56.0, 50.0, 63.6, "HIGH"),
]


@pytest.fixture(scope="module")
def assessed(spark):
    rows = [(i, g[0], g[1], g[2], g[3], g[4]) for i, g in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["id"]: r["risk"] for r in df.select(
        "id", assess(F.col("flags"), F.col("confidence"), F.col("score"), F.col("flagged"),
                     F.col("trusted")).alias("risk")).collect()}


def test_golden_vectors(assessed):
    for i, g in enumerate(GOLDEN):
        r = assessed[i]
        assert (r["rule_score"], r["ml_score"], r["level"]) == (g[5], g[6], g[8])
        assert abs(r["score"] - g[7]) < 0.01


def test_explanations(assessed):
    assert assessed[0]["explanation"] == "ML anomaly score=0.1000"
    assert assessed[3]["rule_findings"] == ["mac_ip_change", "unsolicited_reply=0.80", "high_arp_rate"]
    assert assessed[2]["explanation"].endswith("Trusted-device adjustment applied")


def test_null_score_paths(spark):
    df = spark.createDataFrame([(1, {}, {}, None, True, False), (2, {}, {}, None, False, False)], SCHEMA)
    r = {x["id"]: x["risk"] for x in df.select("id", assess(F.col("flags"), F.col("confidence"), F.col("score"),
                                                            F.col("flagged"), F.col("trusted")).alias("risk"))
         .collect()}
    assert r[1]["ml_score"] == 100.0 and r[2]["ml_score"] == 0.0
    assert r[2]["explanation"] == "No significant detection evidence"


def test_normalize_mac(spark):
    got = spark.createDataFrame([(" AA-BB-CC-DD-EE-FF ",)], "m string").select(normalize_mac(F.col("m"))).first()[0]
    assert got == "aa:bb:cc:dd:ee:ff"


def test_trust_add_and_lookup(spark):
    store = TR.upsert(TR.empty_store(spark),
                      spark.createDataFrame([("AA-BB-CC-DD-EE-FF", "192.168.1.10", "Laptop", 1)],
                                            "mac string, ip string, label string, seq long"),
                      "2024-01-01T00:00:00+00:00")
    ev = spark.createDataFrame([("aa:bb:cc:dd:ee:ff", "192.168.1.10"), ("aa:bb:cc:dd:ee:ff", "192.168.1.11"),
                                ("aa:bb:cc:dd:ee:ff", None), ("11:22:33:44:55:66", "192.168.1.10")],
                               "device_mac string, device_ip string")
    got = [r["trusted"] for r in TR.trusted_flag(ev, store).orderBy("device_mac", "device_ip").collect()]
    # ordering: 11:22.. first, then aa.. with ip null, .10, .11
    assert got == [False, True, True, False]


def test_trust_update_rules(spark):
    s0 = TR.upsert(TR.empty_store(spark), spark.createDataFrame(
        [("aa-bb-cc-dd-ee-ff", None, "Laptop", 1)], "mac string, ip string, label string, seq long"), "t0")
    s1 = TR.upsert(s0, spark.createDataFrame(
        [("AA:BB:CC:DD:EE:FF", "10.0.0.2", "", 1), ("AA:BB:CC:DD:EE:FF", None, "Work laptop", 2)],
        "mac string, ip string, label string, seq long"), "t1").collect()
    assert len(s1) == 1
    r = s1[0]
    assert (r["mac"], r["ip"], r["label"], r["added_at"]) == ("aa:bb:cc:dd:ee:ff", "10.0.0.2", "Work laptop", "t0")
    remaining, removed = TR.remove(TR.upsert(TR.empty_store(spark), spark.createDataFrame(
        [("aa:bb:cc:dd:ee:ff", None, "x", 1)], "mac string, ip string, label string, seq long"), "t"),
        spark.createDataFrame([("AA-BB-CC-DD-EE-FF",)], "mac string"))
    assert remaining.count() == 0 and removed.count() == 1


def _request(spark):
    inc = spark.createDataFrame(
        [("i1", "CRITICAL", ("aa:bb:cc:dd:ee:ff", None, ("High risk",)))],
        "incident_id string, severity string, details struct<device_mac:string,device_ip:string,"
        "risk:struct<explanation:string>>")
    return Q.create_requests(inc, "2024-01-01T00:00:00+00:00")


def test_approval_is_required(spark):
    req = _request(spark)
    assert [r["request_id"] for r in req.collect()] == ["resp-1"]
    cmds = spark.createDataFrame(
        [("resp-1", 1, "execute", None, "t1"), ("resp-1", 2, "approve", "admin", "t2"),
         ("resp-1", 3, "execute", None, "t3"), ("resp-9", 1, "approve", "admin", "t4")],
        "request_id string, order int, command string, admin string, at string")
    state, errors = Q.apply_commands(req, cmds)
    r = state.first()
    assert r["status"] == "EXECUTED" and r["approved_by"] == "admin" and r["executed_at"] == "t3"
    assert r["result"] == "DRY_RUN: ISOLATE_DEVICE for {'mac': 'aa:bb:cc:dd:ee:ff', 'ip': None}"
    errs = sorted(e["error"] for e in errors.collect())
    assert errs == ["Administrator approval is required before execution (order 1)",
                    "Unknown response request: resp-9"]


def test_commands_out_of_order_and_reject(spark):
    req = _request(spark)
    cmds = spark.createDataFrame(
        [("resp-1", 2, "approve", "admin", "t2"), ("resp-1", 1, "reject", "boss", "t1")],
        "request_id string, order int, command string, admin string, at string")
    state, errors = Q.apply_commands(req, cmds)
    assert state.first()["status"] == "REJECTED" and state.first()["approved_by"] == "boss"
    assert [e["error"] for e in errors.collect()] == ["Only pending requests can be approved (order 2)"]


def test_action_whitelist(spark):
    df = spark.createDataFrame([("r1", "isolate_device"), ("r2", "ARP_POISON")], "request_id string, action string")
    ok, bad = Q.validate_actions(df)
    assert [r["action"] for r in ok.collect()] == ["ISOLATE_DEVICE"]
    assert bad.first()["error"] == "Unsupported defensive action: ARP_POISON"
