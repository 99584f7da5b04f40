from pyspark.sql import functions as F

from conftest import make_packets
from lanwatch.operators import features as W
from lanwatch.schema import MODEL_FEATURES

S = 1_000_000


def test_fixture_windows(packets):
    f = W.engineer_features(packets).orderBy("window_start").collect()
    assert len(f) == 5                                     # 99.9 s span -> 4 windows + trailing empty one
    assert sum(1 for r in f if r["arp_request_count"] + r["arp_reply_count"] > 0) == 4
    assert sum(r["mac_ip_change_count"] for r in f) == 129
    assert max(r["max_packets_per_mac"] for r in f) == 100
    assert all(r[c] == 0 for c in MODEL_FEATURES for r in f[-1:])


def test_w7_identity(packets):
    f = W.engineer_features(packets)
    bad = f.where(F.col("mac_ip_change_count") != F.col("ip_mac_pair_count") - F.col("unique_src_macs"))
    assert bad.count() == 0


def test_empty_input(spark):
    f = W.engineer_features(make_packets(spark, []))
    assert f.count() == 0
    assert f.columns == ["window_start"] + MODEL_FEATURES


def test_single_packet(spark):
    f = W.engineer_features(make_packets(spark, [(1, 10 * S, 1, "a", None, "1.1.1.1", "2.2.2.2")])).collect()
    assert len(f) == 1 and f[0]["arp_request_count"] == 1 and f[0]["reply_request_ratio"] == 0.0


def test_exact_multiple_span_has_no_trailing_empty_window(spark):
    rows = [(1, 0, 1, "a", None, "1.1.1.1", "x"), (2, 60 * S, 2, "a", None, "1.1.1.1", "x")]
    f = W.engineer_features(make_packets(spark, rows)).orderBy("window_start").collect()
    assert [r["arp_request_count"] + r["arp_reply_count"] for r in f] == [1, 0, 1]


def test_other_op_and_null_target(spark):
    rows = [(1, 0, 3, "a", None, "1.1.1.1", None), (2, 1 * S, 2, "a", None, "1.1.1.1", None)]
    r = W.engineer_features(make_packets(spark, rows)).collect()[0]
    assert (r["arp_request_count"], r["arp_reply_count"], r["unique_dst_ips"]) == (0, 1, 0)
    # 1 excess reply over 2 packets (op 3 counts in the total only)
    assert r["unsolicited_reply_ratio"] == 0.5


def test_summary_and_range(packets):
    s = {r["feature"]: r for r in W.feature_summary(W.engineer_features(packets)).collect()}
    assert set(s) == set(MODEL_FEATURES)
    t = W.time_range(packets).collect()[0]
    assert t["packets"] == 1000 and abs(t["duration_s"] - 99.9) < 1e-9


def test_epoch_anchor(packets):
    f = W.engineer_features(packets, anchor="epoch").collect()
    assert all(r["window_start"] % 30 == 0 for r in f)
