"""Rules over a stream with whole records: equality with the batch rules, hot keys, late rows, retries."""

import random

from conftest import make_packets
from pyspark.sql import functions as F

from lanwatch.operators import rules as R
from lanwatch.streaming import incremental as I
from lanwatch.streaming import stream as V

S = 1_000_000
T0 = 1_700_000_000 * S


def hot_rows(n=900):
    """One IP and one MAC hold most rows; ties in time; null targets; gaps longer than every window."""
    r, rows, t = random.Random(4), [], T0
    for i in range(n):
        t += r.choice((0, 0, 100_000, 300_000, 2 * S)) + (400 * S if i % 300 == 299 else 0)
        hot = r.random() < 0.6
        ip = "192.168.1.1" if hot else r.choice(("10.0.0.1", "10.0.0.2", "10.0.0.3"))
        mac = r.choice(("m1", "m1", "m1", "m2", "m3", "m4")) if hot else r.choice(("m1", "m9", "m8"))
        rows.append((i, t, r.choice((1, 1, 1, 2)), mac, None, ip, r.choice((None, *[f"10.1.0.{k}" for k in range(40)]))))
    return rows


def records(df):
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*R.DETECTION_COLUMNS))).collect())


def run(spark, batches, path, delay_us=5 * S, first=0):
    for k, rows in enumerate(batches, first):
        I.run_batch(make_packets(spark, rows), k, path, delay_us)


def cut(rows, at):
    edges = [0, *at, len(rows)]
    return [rows[a:b] for a, b in zip(edges, edges[1:], strict=False)]


CLOSE = [(10 ** 9, 4_000_000_000 * S, 2, "zz", None, "0.0.0.0", None)]


def test_records_equal_the_batch_rules(spark, tmp_path):
    """Rows out of order within the delay, over several triggers, one of them run again as after a crash."""
    path, rows = str(tmp_path), hot_rows()
    want = records(R.run_rules(make_packets(spark, rows)))
    parts = cut(sorted(rows, key=lambda r: r[1] + random.Random(r[0]).randrange(4 * S)), (250, 610))
    run(spark, parts[:2], path)
    run(spark, parts[1:2], path, first=1)
    run(spark, [parts[2], CLOSE], path, first=2)
    got = I.detections(spark, path)
    assert records(got) == want and len(want) > 200
    assert {r.rule_no for r in got.select("rule_no").distinct().collect()} == {1, 2, 3, 4, 5}
    assert I.late_rows(spark, path).count() == 0
    # a retry needs the state before it; older ones go
    assert sorted(p.name for p in (tmp_path / "state").iterdir() if p.is_dir()) == ["batch=2", "batch=3"]


def test_late_rows_are_counted_and_state_expires(spark, tmp_path):
    path, ip = str(tmp_path), "10.0.0.9"
    early = [(i, T0 + i * S, 2, ip, f"m{i % 2}", None) for i in range(50)]
    late = [(200, T0 + 3 * S, 2, ip, "m9", None), (201, T0 + 4 * S, 2, None, "m9", None), (202, None, 2, ip, "m9", None)]
    fresh = [(300, T0 + 10_000 * S, 2, "10.0.0.8", "m1", None)]
    for k, rows in enumerate([early, late + fresh]):
        I.run_batch(spark.createDataFrame(rows, I._PACKET), k, path, 5 * S)
    assert {(r.batch, r.src_ip, r.late_rows) for r in I.late_counts(spark, path).collect()} == {(1, ip, 2), (1, None, 1)}
    assert I.detections(spark, path).where("device_mac = 'm9'").count() == 0
    state = I.load_state(spark, path, 1)
    assert [r.seq for r in state["recent"].where(F.col("src_ip") == ip).collect()] == [49]
    assert state["changes"].where(F.col("src_ip") == ip).count() == I.KEPT_CHANGES
    assert state["addresses"].where(F.col("src_ip") == ip).first()[1:] == (50, 49)
    assert [r.seq for r in state["pending"].collect()] == [300]


def test_the_query_itself(spark, tmp_path):
    d, rows = str(tmp_path), hot_rows(300)
    want = records(R.run_rules(make_packets(spark, rows)))
    for k, part in enumerate([rows, CLOSE]):
        make_packets(spark, part).coalesce(1).write.parquet(f"{d}/in/{k}")
    for _ in range(2):                                       # the second start finds nothing new
        src = V.read_packet_stream(spark, f"{d}/in/*", max_files_per_trigger=1)
        I.stream_rules(src, f"{d}/out", f"{d}/ck", delay_seconds=5).awaitTermination()
        assert records(I.detections(spark, f"{d}/out")) == want
