"""Paths, columns by name, and ids that don't depend on how files are split."""

import pytest
from pyspark.sql import functions as F

from lanwatch import session
from lanwatch.operators import incidents as I
from lanwatch.operators import responses as Q
from lanwatch.operators import rules as R
from lanwatch.operators import trust as T
from lanwatch.sources import packets as S
from lanwatch.sources import sinks as K

HEADER = "timestamp,op,src_mac,dst_mac,src_ip,dst_ip"


def capture(path, start, mac="aa:aa:aa:aa:aa:01", n=400):
    rows = [f"{start + i / 100},{1 + i % 2},{mac if i % 3 else 'aa:aa:aa:aa:aa:02'},ff:ff:ff:ff:ff:ff,10.0.0.{i % 5},10.0.1.{i % 30}" for i in range(n)]
    path.write_text("\n".join([HEADER, *rows]) + "\n")


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_state_and_incidents_by_any_path(spark, tmp_path, form):
    path = form.format(tmp_path)
    store = spark.createDataFrame([("aa", "1.1.1.1", "x", "t")], T.TRUST_SCHEMA)
    assert K.load_state(spark, f"{path}/none", T.TRUST_SCHEMA).count() == 0
    K.save_state(store, f"{path}/trust")
    assert K.load_state(spark, f"{path}/trust", T.TRUST_SCHEMA).collect() == store.collect()
    assert I.read_incidents(spark, f"{path}/log").count() == 0
    inc = spark.createDataFrame([("i", "t", "s", "ARP_ANOMALY", "LOW", None)], I.INCIDENT_SCHEMA)
    I.append_incidents(inc, f"{path}/log")
    I.append_incidents(inc, f"{path}/log")
    assert [r.incident_id for r in I.read_incidents(spark, f"{path}/log").collect()] == ["i", "i"]
    (tmp_path / "log" / "part-bad.json").write_text("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        I.read_incidents(spark, f"{path}/log").collect()


def test_ids_do_not_depend_on_splits(spark, tmp_path):
    capture(tmp_path / "a.csv", 1_700_000_000)
    found = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "4k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            p = S.read_packet_csv(spark, str(tmp_path / "a.csv"))
            if size == "4k":
                assert p.select(F.spark_partition_id()).distinct().count() > 2
            assert sorted(r.seq for r in p.collect()) == list(range(400))
            found.append(sorted(r.detection_id for r in R.run_rules(p).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] and found[0]
    capture(tmp_path / "b.csv", 1_800_000_000)
    other = {r.detection_id for r in R.run_rules(S.read_packet_csv(spark, str(tmp_path / "b.csv"))).collect()}
    assert other and not other & set(found[0])


def test_columns_bind_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n1.0,1,m1,d1,i1,t1\n")
    (tmp_path / "b.csv").write_text("src_ip,src_mac,extra,op,timestamp,dst_ip,dst_mac\ni2,m2,x,2,2.0,t2,d2\n")
    got = S.read_packet_csv(spark, [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")]).orderBy("seq").collect()
    assert [(r.seq, r.op, r.src_mac, r.src_ip, r.dst_mac, r.dst_ip) for r in got] == [(0, 1, "m1", "i1", "d1", "t1"), (1, 2, "m2", "i2", "d2", "t2")]
    (tmp_path / "c.csv").write_text("op,src_mac\n1,m\n")
    with pytest.raises(S.ContractError, match="timestamp"):
        S.read_packet_csv(spark, str(tmp_path))


def test_request_order_takes_every_column(spark):
    rows = [("i1", "b", 1), ("i2", "a", 2), ("i3", "a", 1)]
    inc = spark.createDataFrame(rows, "incident_id string, p string, q int").selectExpr(
        "*", "'HIGH' AS severity", "named_struct('device_mac', 'm', 'device_ip', 'i', 'risk', named_struct('explanation', 'e')) AS details")
    got = {r.incident_id: r.request_id for r in Q.create_requests(inc, "t", order_cols=("p", "q")).collect()}
    assert got == {"i3": "resp-1", "i2": "resp-2", "i1": "resp-3"}


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_rules_may_normalise_macs(spark):
    from tests.conftest import make_packets
    macs = ["AA-BB-CC-00-00-01", "aa:bb:cc:00:00:01", " aa:bb:CC:00:00:01 "]
    p = make_packets(spark, [(i, 1_700_000_000_000_000 + i, 1, macs[i % 3], "d", "10.0.0.9", "10.0.0.1") for i in range(9)])
    rules = ["ip_mac_change", "duplicate_ip", "gateway_change"]
    assert R.run_rules(p, rules).count() > 0
    assert R.run_rules(p, rules, normalize_macs=True).count() == 0


def test_missing_targets_are_no_target(spark):
    from tests.conftest import make_packets
    rows = [(i, 1_700_000_000_000_000 + i, 1, "aa", "d", "10.0.0.9", f"10.0.1.{i}" if i < 20 else None) for i in range(21)]
    for semantics in ("documented", "observed"):
        assert R.rule_request_storm(make_packets(spark, rows), semantics).count() == 0


def test_numbers_continue_after_the_store(spark):
    inc = spark.createDataFrame([("i1",), ("i2",)], "incident_id string").selectExpr(
        "*", "'HIGH' AS severity", "named_struct('device_mac', 'm', 'device_ip', 'i', 'risk', named_struct('explanation', 'e')) AS details")
    first = Q.create_requests(inc, "t")
    assert sorted(r.request_id for r in Q.create_requests(inc, "t", existing=first).collect()) == ["resp-3", "resp-4"]
