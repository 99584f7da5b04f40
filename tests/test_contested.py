"""Only the groups that can fire go through the windows of the rules, with the results of the rules run alone."""

import pytest
from pyspark.sql import functions as F

from conftest import make_packets
from lanwatch.operators import rules as R

S = 1_000_000
T0 = 1_700_000_000 * S


def _rows():
    rows = []

    def add(t, mac, ip, dst="10.0.0.1", op=1):
        rows.append((len(rows), T0 + int(t * S), op, mac, "ff:ff:ff:ff:ff:ff", ip, dst))
    for k in range(40):                          # quiet hosts, one MAC each
        for t in (0, 200, 700):
            add(t + k / 10, f"02:00:00:00:01:{k:02d}", f"10.0.1.{k}")
    for k in range(6):                           # one IP claimed by three MACs, one packet again after a long pause
        add(20 + k, f"02:00:00:00:02:0{k % 3}", "10.0.2.1", op=2)
    add(5000, "02:00:00:00:02:00", "10.0.2.1", op=2)
    for k in range(3):                           # no IP, two MACs
        add(30 + k, f"02:00:00:00:03:0{k % 2}", "", op=2)
    for k in range(60):                          # a scan, over the limit of the rate as well
        add(50 + k / 4, "02:00:00:00:04:00", "10.0.4.1", dst=f"10.1.0.{k % 30}" if k % 7 else None)
    for k in range(25):                          # as many requests as targets, too few packets for the rate
        add(300 + k, "02:00:00:00:05:00", "10.0.5.1", dst=f"10.2.0.{k}")
    return rows


def _packets(spark):
    return make_packets(spark, _rows()).withColumn("src_ip", F.nullif("src_ip", F.lit("")))


@pytest.mark.parametrize("broadcast", [R.BROADCAST_IPS, 0] if hasattr(R, "BROADCAST_IPS") else [0])
def test_rules_of_contested_packets(spark, monkeypatch, broadcast):
    monkeypatch.setattr(R, "BROADCAST_IPS", broadcast, raising=False)
    p = _packets(spark)
    want = {r[0] for r in _rows() if r[5] in ("10.0.2.1", "")}
    got = [r.seq for r in R.contested_packets(p).collect()]
    assert len(got) == len(want) and set(got) == want
    cols = ["detection_id", "event_type", "severity", "reason", "device_ip", "device_mac", "info"]
    for one, alone in zip(R.ip_rules(p, ["10.0.2.1"]), (R.rule_ip_mac_change(p), R.rule_duplicate_ip(p), R.rule_gateway_change(p, ["10.0.2.1"])),
                          strict=True):
        found = sorted(map(str, one.select(*cols).collect()))
        assert found and found == sorted(map(str, alone.select(*cols).collect()))


def test_one_claim_is_enough(spark):
    p = _packets(spark)
    _, d2, _ = R.ip_rules(p, high=1)
    assert d2.count() == len(_rows())


def test_quiet_macs_are_not_laid_out(spark, monkeypatch):
    written = []
    materialize = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df: written.append(materialize(df)) or written[-1])
    p = _packets(spark)
    d4, d5 = R.mac_rules(p)
    assert {r.src_mac for df in written for r in df.collect()} == {"02:00:00:00:04:00", "02:00:00:00:05:00"}
    cols = ["detection_id", "event_type", "severity", "reason", "info"]
    for one, alone in ((d4, R.rule_unusual_rate(p)), (d5, R.rule_request_storm(p))):
        found = sorted(map(str, one.select(*cols).collect()))
        assert found and found == sorted(map(str, alone.select(*cols).collect()))
