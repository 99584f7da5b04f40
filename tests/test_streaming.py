import time

from conftest import make_packets
from lanwatch.streaming import stream as V

S = 1_000_000
T0 = 1_700_000_000 * S   # realistic times: the initial watermark (epoch 0) must not make rows late


def test_late_packet_is_dropped(spark, tmp_path):
    d = str(tmp_path)
    ip = "10.9.9.9"

    def arrive(name, rows):
        # each file arrives, then one availableNow pass runs on the same checkpoint
        make_packets(spark, rows).coalesce(1).write.parquet(f"{d}/in/{name}")
        src = V.read_packet_stream(spark, f"{d}/in/*", watermark="10 seconds")
        q = (V.stream_ip_rules(src).writeStream.format("parquet").option("path", f"{d}/out")
             .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
        q.awaitTermination()

    arrive("1", [(i, T0 + i * S, 2, "m1" if i % 2 else "m2", None, ip, None) for i in range(6)])
    arrive("2", [(100, T0 + 1000 * S, 1, "zz", None, "10.0.0.0", None)])
    # arrives after the watermark passed its time: late, must not produce a detection
    arrive("3", [(200, T0 + 3 * S, 2, "m9", None, ip, None)])
    arrive("4", [(300, T0 + 2000 * S, 1, "zz", None, "10.0.0.0", None)])
    out = spark.read.parquet(f"{d}/out")
    got = {r["seq"] for r in out.where("rule_no = 1").collect()}
    assert got == {1, 2, 3, 4, 5}
    assert 200 not in {r["seq"] for r in out.collect()}


def test_stream_risk_writes_incidents(spark, packets, tmp_path):
    from lanwatch.operators import trust as TR
    d = str(tmp_path)
    packets.write.parquet(f"{d}/in/a")
    make_packets(spark, [(10 ** 9, 1_800_000_000 * S, 1, "ff:ff:ff:ff:ff:00", None, "0.0.0.9", None)]) \
        .write.parquet(f"{d}/in/b")
    src = V.read_packet_stream(spark, f"{d}/in/*", watermark="10 seconds")
    dets = V.stream_mac_rules(src)
    q = V.stream_risk(dets, TR.empty_store(spark), f"{d}/inc", f"{d}/ck", "2024-01-01T00:00:00+00:00")
    q.awaitTermination()
    inc = V.current_incidents(spark, f"{d}/inc")
    assert inc.count() > 0
    assert inc.select("incident_id").distinct().count() == inc.count()


def test_a_window_split_over_batches_is_scored_whole(spark, tmp_path):
    from pyspark.sql import functions as F
    from lanwatch.operators import trust as TR
    d, w = str(tmp_path), 1_700_000_010 * S - (1_700_000_010 * S) % (30 * S)
    cols = "rule_no int, seq long, ts_us long, event_type string, severity string, device_ip string, device_mac string, measure long"
    rows = [(4, 1, w + 1, "UNUSUAL_ARP_ACTIVITY", "MEDIUM", "10.0.0.1", "aa", 1), (1, 2, w + 2, "IP_MAC_MAPPING_CHANGE", "HIGH", "10.0.0.1", "aa", 1),
            (4, 3, w + 3, "UNUSUAL_ARP_ACTIVITY", "MEDIUM", None, "bb", 1)]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], cols).coalesce(1).write.parquet(f"{d}/in/{i}")
        dets = spark.readStream.schema(cols).parquet(f"{d}/in/*")
        V.stream_risk(dets, TR.empty_store(spark), f"{d}/inc", f"{d}/ck", "t").awaitTermination()
    got = {r.details.device_mac: r.details.risk.score for r in V.current_incidents(spark, f"{d}/inc").collect()}
    assert got == {"aa": 0.6 * (30 + 10 + 10), "bb": 0.6 * (10 + 10)}
    log = spark.read.json(f"{d}/inc").groupBy("incident_id").agg(F.count("*").alias("n")).collect()
    assert sorted(r.n for r in log) == [1, 2]


def test_ip_state_survives_idle_time(spark, tmp_path):
    """A MAC change after a long quiet spell is still seen (state kept per IP)."""
    from lanwatch.operators import rules as R
    d = str(tmp_path)
    ip = "10.8.8.8"
    rows = [(0, T0, 2, "m1", None, ip, None),
            (1, T0 + 3600 * S, 1, "other", None, "10.0.0.1", None),      # an hour of other traffic
            (2, T0 + 7200 * S, 2, "m2", None, ip, None),                 # change two hours later
            (3, T0 + 9000 * S, 1, "zz", None, "10.0.0.0", None)]         # closes the watermark
    for i, r in enumerate(rows):
        make_packets(spark, [r]).coalesce(1).write.parquet(f"{d}/in/{i}")
        src = V.read_packet_stream(spark, f"{d}/in/*", watermark="10 seconds")
        q = (V.stream_ip_rules(src).writeStream.format("parquet").option("path", f"{d}/out")
             .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    got = {(r["rule_no"], r["seq"], r["measure"]) for r in spark.read.parquet(f"{d}/out").collect()}
    assert (1, 2, 1) in got                                   # change number 1 at seq 2
    batch = R.rule_ip_mac_change(make_packets(spark, rows)).collect()
    assert [r["seq"] for r in batch] == [2]


def test_state_is_kept_by_groups_of_keys(spark, tmp_path):
    """Many senders make no more state rows than groups; hot and quiet ones, match the batch rules."""
    from lanwatch.operators import rules as R
    d = str(tmp_path)
    rows = [(i, T0 + i * S // 50, 1 if i % 3 else 2, f"m{i % 1500}" if i % 4 else "hot", None, f"10.1.{i % 1300}" if i % 5 else "192.168.1.1",
             None if i % 11 == 0 else f"t{i % 90}") for i in range(4000)]
    close = [(10 ** 9, T0 + 10 ** 6 * S, 2, "zz", None, "0.0.0.9", None)]
    batch = make_packets(spark, rows)
    for rules, nos in ((V.stream_ip_rules, (1, 2, 3)), (V.stream_mac_rules, (4, 5))):
        at, kept = f"{d}/{rules.__name__}", []
        for k, part in enumerate((rows, close)):
            make_packets(spark, part).write.parquet(f"{at}/in/{k}")
            q = (rules(V.read_packet_stream(spark, f"{at}/in/*", watermark="10 seconds")).writeStream.format("parquet")
                 .option("path", f"{at}/out").option("checkpointLocation", f"{at}/ck").trigger(availableNow=True).start())
            q.awaitTermination()
            kept += [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        assert 0 < max(kept) <= V.KEY_GROUPS
        cols = ["rule_no", "seq", "event_type", "severity", "device_ip", "device_mac"]
        got = sorted(map(str, spark.read.parquet(f"{at}/out").where("seq < 1000000000").select(*cols).collect()))
        want = sorted(map(str, R.run_rules(batch).where(f"rule_no IN {nos}").select(*cols).collect()))
        assert got == want and len(want) > 100


def test_findings_of_many_hours_make_no_more_files_than_tasks(spark, tmp_path):
    from lanwatch.operators import trust as TR
    d = str(tmp_path)
    cols = "rule_no int, seq long, ts_us long, event_type string, severity string, device_ip string, device_mac string, measure long"
    rows = [(4, i, T0 + i * 600 * S, "UNUSUAL_ARP_ACTIVITY", "MEDIUM", f"10.0.0.{i % 7}", "aa", 1) for i in range(600)]
    spark.createDataFrame(rows, cols).write.parquet(f"{d}/in/0")
    V.stream_risk(spark.readStream.schema(cols).parquet(f"{d}/in/*"), TR.empty_store(spark), f"{d}/inc", f"{d}/ck", "t").awaitTermination()
    files = list(tmp_path.glob("inc-findings/**/*.parquet"))
    assert 0 < len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert V.current_incidents(spark, f"{d}/inc").count() == 600


def test_events_of_a_hot_mac_are_dealt_over_tasks(spark):
    from pyspark.sql import functions as F
    from lanwatch.operators import trust as TR
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        store = spark.createDataFrame([("hot", "10.0.0.1", "", "t"), ("any", None, "", "t")], TR.TRUST_SCHEMA)
        events = spark.createDataFrame([("hot", f"10.0.0.{i}") for i in range(200)] + [("hot", None), ("any", "x"), (None, "x"), ("no", "x")],
                                       "device_mac string, device_ip string")
        out = TR.trusted_flag(events, store)
        tasks = out.where("device_mac = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 1
        assert out.count() == 204
        assert {tuple(r) for r in out.where("trusted").select("device_mac", "device_ip").collect()} == {
            ("hot", "10.0.0.1"), ("hot", None), ("any", "x")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept[0])
        spark.conf.set("spark.sql.adaptive.enabled", kept[1])


def _arrivals(spark, tmp_path, monkeypatch, query):
    """Run a query over own packets in four files; returns its rows and the number of files of each arrival."""
    from lanwatch.plans import catalog  # noqa: F401  loads the query modules in order
    from lanwatch.plans import q_stream as Q
    rows = [(i, T0 + i * S, 2, f"m{i % 3}", None, f"10.0.0.{i % 2}", None) for i in range(400)]
    monkeypatch.setattr(Q.fixture, "packets", lambda *_: make_packets(spark, rows).repartition(4))
    monkeypatch.setattr(Q, "scratch", lambda *_: str(tmp_path))
    got = getattr(Q, query)(spark, "").collect()
    files = {k: len(list((tmp_path / "in" / k).glob("*.parquet"))) for k in ("0", "1")}
    return rows, got, files


def test_records_of_arrivals_in_many_files(spark, tmp_path, monkeypatch):
    from lanwatch.operators import rules as R
    rows, got, files = _arrivals(spark, tmp_path, monkeypatch, "stream_rules_record")
    assert min(files.values()) > 1                       # no task writes a whole arrival
    assert sorted(r.detection_id for r in got) == sorted(r.detection_id for r in R.run_rules(make_packets(spark, rows)).collect())


def test_late_rows_of_arrivals_in_many_files(spark, tmp_path, monkeypatch):
    rows, got, files = _arrivals(spark, tmp_path, monkeypatch, "stream_late_data")
    assert min(files.values()) > 1
    late = [r for r in rows if r[0] % 50 == 7 and r[1] <= T0 + 389 * S]
    assert sum(r.late_rows for r in got) == len(late) == 8
