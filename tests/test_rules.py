from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import make_packets
from lanwatch.operators import alerts as H
from lanwatch.operators import rules as R

S = 1_000_000


@pytest.fixture(scope="module")
def dets(packets):
    return R.run_rules(packets).collect()


def _count(dets, **kw):
    return sum(1 for d in dets if all(d[k] == v for k, v in kw.items()))


def test_documented_counts_sf0001(dets):
    assert _count(dets, rule_no=1) == 27
    assert _count(dets, event_type="ARP_SPOOFING_ATTACK") == 21
    assert _count(dets, rule_no=3) == 20
    assert (_count(dets, rule_no=2, severity="HIGH"), _count(dets, rule_no=2, severity="CRITICAL")) == (2, 4)
    assert (_count(dets, event_type="UNUSUAL_ARP_ACTIVITY"), _count(dets, event_type="MAC_FLOODING")) == (80, 30)
    assert _count(dets, rule_no=5) == 168


def test_observed_mode(packets):
    d = R.run_rules(packets, semantics="observed").collect()
    assert _count(d, rule_no=1) == 0 and _count(d, rule_no=3) == 0      # state updated before the check
    assert (_count(d, event_type="UNUSUAL_ARP_ACTIVITY"), _count(d, event_type="MAC_FLOODING")) == (421, 110)


def test_detection_ids_deterministic(packets):
    a = sorted(r["detection_id"] for r in R.run_rules(packets).select("detection_id").collect())
    b = sorted(r["detection_id"] for r in R.run_rules(packets).select("detection_id").collect())
    assert a == b and len(set(a)) == len(a)


def test_duplicate_claim_details_match_brute_force(packets, dets):
    pk = packets.toPandas()
    for d in [x for x in dets if x["rule_no"] == 2]:
        g = pk[(pk.src_ip == d["device_ip"]) & (pk.ts_us > d["ts_us"] - 60 * S) & (pk.ts_us <= d["ts_us"])]
        want = Counter(g.src_mac)
        assert d["info"]["claims_per_mac"] == dict(want)
        assert d["info"]["claiming_macs"] == sorted(want)
        assert d["info"]["total_claims"] == int(((pk.src_ip == d["device_ip"]) & (pk.ts_us <= d["ts_us"])).sum())


def test_storm_targets_are_first_ten_sorted(packets, dets):
    pk = packets.toPandas()
    for d in [x for x in dets if x["rule_no"] == 5][:20]:
        g = pk[(pk.src_mac == d["device_mac"]) & (pk.op == 1) & (pk.ts_us > d["ts_us"] - 30 * S)
               & (pk.ts_us <= d["ts_us"])]
        assert d["info"]["target_ips"] == sorted(set(g.dst_ip))[:10]
        assert d["info"]["unique_targets"] == g.dst_ip.nunique()


def test_rapid_change_history(spark):
    # one IP alternating between two MACs every second
    rows = [(i, i * S, 2, "m1" if i % 2 else "m2", None, "10.0.0.5", None) for i in range(8)]
    d = R.rule_ip_mac_change(make_packets(spark, rows)).orderBy("seq").collect()
    assert [r["event_type"] for r in d] == ["IP_MAC_MAPPING_CHANGE"] * 3 + ["ARP_SPOOFING_ATTACK"] * 4
    assert d[0]["info"]["change_number"] == 1 and d[2]["info"]["change_number"] == 3
    last = d[-1]["info"]
    assert last["change_count"] == 6 and len(last["change_history"]) == 5


def test_changes_exactly_window_apart_do_not_count(spark):
    macs = ["a", "b", "a", "b", "a"]
    rows = [(i, i, 2, m, None, "10.0.0.9", None) for i, m in enumerate(macs)]
    rows.append((5, 2 + 60 * S, 2, "b", None, "10.0.0.9", None))
    d = {r["seq"]: r for r in R.rule_ip_mac_change(make_packets(spark, rows)).collect()}
    assert d[4]["event_type"] == "ARP_SPOOFING_ATTACK"      # changes at 1, 2, 3 are earlier and within 60 s
    # at t = 2 + 60 s the frame is (2, t]: the change at exactly t - 60 s is out, 3 and 4 remain
    assert d[5]["event_type"] == "IP_MAC_MAPPING_CHANGE"


def test_gateway_rule_custom_list(spark):
    rows = [(i, i * S, 2, "g1" if i % 2 else "g2", None, "172.16.0.1", None) for i in range(4)]
    p = make_packets(spark, rows)
    assert R.rule_gateway_change(p).count() == 0
    d = R.rule_gateway_change(p, ["172.16.0.1"]).orderBy("seq").collect()
    assert len(d) == 3 and len(d[-1]["info"]["gateway_history"]) == 3


def test_user_rule_registration(packets):
    @R.register_rule("broadcast_reply", 9)
    def broadcast_reply(p, semantics="documented"):
        x = p.where((F.col("op") == 2) & (F.col("dst_mac") == "ff:ff:ff:ff:ff:ff"))
        return R._detections(x, 9, F.lit("SUSPICIOUS_ARP_RATE"), F.lit("LOW"), F.lit("reply to broadcast"),
                             R._info())
    try:
        out = R.run_rules(packets, rules=["broadcast_reply", "unusual_rate"])
        assert set(r["rule_no"] for r in out.select("rule_no").distinct().collect()) <= {4, 9}
    finally:
        R._REGISTRY.pop("broadcast_reply")


def test_mapping_state(packets):
    st = {r["src_ip"]: r for r in R.ip_mapping_state(packets).collect()}
    gw = st["192.168.1.1"]
    assert gw["is_gateway"] and gw["change_count"] == 20 and gw["packet_count"] == 21
    obs = {r["src_ip"]: r for r in R.ip_mapping_state(packets, semantics="observed").collect()}
    assert obs["192.168.1.1"]["packet_count"] == 20


def test_history_operators(packets):
    d = R.run_rules(packets)
    assert H.filter_detections(d, severity="CRITICAL", limit=5).count() == 5
    assert H.filter_detections(d, event_type="ARP_REQUEST_STORM", limit=0).count() == 168
    stats = {(r["dimension"], r["value"]): r["detections"] for r in H.detection_statistics(d).collect()}
    assert stats[("total", "all")] == d.count()
    routed = H.alert_routing(d).where("NOT to_console").count()
    assert routed == 0                                               # nothing LOW or INFO is emitted
    assert H.clear_history(d).count() == 0
    j = H.detection_json(d).first()["json"]
    assert '"affected_device"' in j and '"additional_info"' in j


def test_stream_equals_batch(spark, packets, tmp_path):
    from lanwatch.streaming import stream as V
    d = str(tmp_path)
    packets.write.parquet(f"{d}/in/a")
    # a closing packet far in the future moves the watermark past every real one
    make_packets(spark, [(10 ** 9, 1_800_000_000 * S, 1, "ff:ff:ff:ff:ff:00", None, "0.0.0.9", None)]) \
        .write.parquet(f"{d}/in/b")
    src = V.read_packet_stream(spark, f"{d}/in/*", watermark="10 seconds")
    qs = [V.stream_ip_rules(src).writeStream.format("memory").queryName("t_ipr")
          .option("checkpointLocation", f"{d}/c1").trigger(availableNow=True).start(),
          V.stream_mac_rules(src).writeStream.format("memory").queryName("t_macr")
          .option("checkpointLocation", f"{d}/c2").trigger(availableNow=True).start(),
          V.stream_window_features(src).writeStream.format("memory").queryName("t_wf")
          .option("checkpointLocation", f"{d}/c3").trigger(availableNow=True).start()]
    for q in qs:
        q.awaitTermination()
    got = spark.sql("SELECT rule_no, seq, event_type, severity FROM t_ipr UNION ALL "
                    "SELECT rule_no, seq, event_type, severity FROM t_macr").where("seq < 1000000000")
    exp = R.run_rules(packets).select("rule_no", "seq", "event_type", "severity")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    from lanwatch.operators import features as W
    batch = {r["window_start"]: r.asDict() for r in W.engineer_features(packets, anchor="epoch").collect()
             if r["arp_request_count"] + r["arp_reply_count"] > 0}
    stream = {r["window_start"]: r.asDict() for r in spark.sql("SELECT * FROM t_wf").collect()
              if r["window_start"] < 1_800_000_000}
    assert batch == stream


def test_combined_mac_rules_equal_separate_rules(packets):
    d4, d5 = R.mac_rules(packets)
    key = lambda r: (r["rule_no"], r["seq"], r["event_type"], r["severity"], r["reason"],
                     tuple(sorted((k, str(v)) for k, v in r["info"].asDict().items())))
    together = sorted(map(key, d4.unionByName(d5).collect()))
    apart = sorted(map(key, R.rule_unusual_rate(packets).unionByName(R.rule_request_storm(packets)).collect()))
    assert together == apart and len(together) == 278


def test_combined_ip_rules_equal_separate_rules(packets):
    d1, d2, d3 = R.ip_rules(packets)
    key = lambda r: (r["rule_no"], r["seq"], r["event_type"], r["severity"], r["reason"],
                     str(sorted(r["info"].asDict().items())))
    together = sorted(map(key, d1.unionByName(d2).unionByName(d3).collect()))
    apart = sorted(map(key, R.rule_ip_mac_change(packets).unionByName(R.rule_duplicate_ip(packets))
                       .unionByName(R.rule_gateway_change(packets)).collect()))
    assert together == apart and len(together) == 27 + 6 + 20
