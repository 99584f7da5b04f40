"""Queries for sources and dataset operators."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..operators import dataset as N
from ..session import scratch
from ..sources import fixture
from ..sources import packets as S
from .catalog import register

_PKT_COLS = "seq, ts_us, op, src_mac, dst_mac, src_ip, dst_ip"


def _ml_text(spark, sf_dir):
    """The packet view written out as ML-dialect text columns."""
    p = fixture.packets(spark, sf_dir)
    return p.select(
        "seq",
        (F.col("ts_us") / F.lit(1e6)).cast("string").alias("timestamp"),
        F.col("op").cast("string").alias("op"),
        "src_mac", "dst_mac", "src_ip", "dst_ip")


@register("packet_contract", f"SELECT {_PKT_COLS} FROM packets")
def packet_contract(spark, sf_dir):
    return S.apply_packet_contract(_ml_text(spark, sf_dir))


@register("capture_normalize", """
SELECT strftime(make_timestamp(ts_us), '%Y-%m-%d %H:%M:%S') AS timestamp,
       src_ip AS sender_ip, src_mac AS sender_mac, dst_ip AS target_ip, dst_mac AS target_mac,
       CASE WHEN op = 1 THEN 'request' WHEN op = 2 THEN 'reply' ELSE 'unknown' END AS operation
FROM packets""")
def capture_normalize(spark, sf_dir):
    return S.canonical_to_capture(fixture.packets(spark, sf_dir))


@register("capture_roundtrip", """
SELECT seq, (ts_us // 1000000) * 1000000 AS ts_us, op, src_mac, dst_mac, src_ip, dst_ip FROM packets""")
def capture_roundtrip(spark, sf_dir):
    p = fixture.packets(spark, sf_dir)
    cap = S.canonical_to_capture(p, keep=["seq"])
    return S.capture_to_canonical(cap).select("seq", "ts_us", "op", "src_mac", "dst_mac", "src_ip", "dst_ip")


@register("session_union", """
SELECT CAST(seq % 2 AS INTEGER) AS session, sender_mac, operation, count(*) AS records
FROM (SELECT seq, src_mac AS sender_mac, CASE op WHEN 1 THEN 'request' WHEN 2 THEN 'reply' ELSE 'unknown' END AS operation
      FROM packets) GROUP BY ALL""")
def session_union(spark, sf_dir):
    """Two sessions whose files have their columns in different orders, read as one by name."""
    cap = S.canonical_to_capture(fixture.packets(spark, sf_dir), keep=["seq"])
    paths = [scratch(spark, f"session-{k}") for k in (0, 1)]
    for k, path in enumerate(paths):
        part = cap.where(F.col("seq") % 2 == k).withColumn("session", F.lit(k))
        part.select(*sorted(part.columns, reverse=bool(k))).write.option("header", True).csv(path)
    recs, _ = S.read_sessions(spark, paths, columns=["session", "sender_mac", "operation"])
    return (recs.groupBy(F.col("session").cast("int").alias("session"), "sender_mac", "operation")
            .agg(F.count(F.lit(1)).alias("records")))


@register("dataset_profile", """
SELECT count(*) AS packets,
       count(*) FILTER (WHERE op = 1) AS requests,
       count(*) FILTER (WHERE op = 2) AS replies,
       count(*) FILTER (WHERE op IS NULL OR op NOT IN (1, 2)) AS other_ops,
       count(DISTINCT src_ip) AS distinct_src_ips,
       count(DISTINCT src_mac) AS distinct_src_macs,
       count(*) FILTER (WHERE src_ip = '0.0.0.0') AS unspecified_src
FROM packets""")
def dataset_profile(spark, sf_dir):
    return N.dataset_profile(fixture.packets(spark, sf_dir))


@register("operation_counts", "SELECT op, count(*) AS packets FROM packets GROUP BY op")
def operation_counts(spark, sf_dir):
    return N.operation_counts(fixture.packets(spark, sf_dir))


@register("ip_mac_conflicts", """
SELECT src_ip, count(DISTINCT src_mac) AS n_macs, count(*) AS packets,
       array_to_string(list_sort(list_distinct(list(src_mac))), ',') AS macs
FROM packets WHERE src_ip <> '0.0.0.0'
GROUP BY src_ip HAVING count(DISTINCT src_mac) > 1""")
def ip_mac_conflicts(spark, sf_dir):
    return N.ip_mac_conflicts(fixture.packets(spark, sf_dir))


def _split(spark, sf_dir):
    p = fixture.packets_with_label(spark, sf_dir)
    normal = p.where(F.col("label") == 0).drop("label")
    attack = p.where(F.col("label") == 1).drop("label")
    return normal, attack


@register("label_union_v1", f"SELECT {_PKT_COLS}, label FROM packets")
def label_union_v1(spark, sf_dir):
    normal, attack = _split(spark, sf_dir)
    return N.label_union(normal, attack)


@register("label_union_v2", """
SELECT strftime(make_timestamp(ts_us), '%Y-%m-%d %H:%M:%S') AS timestamp,
       src_ip AS sender_ip, src_mac AS sender_mac, dst_ip AS target_ip, dst_mac AS target_mac,
       CASE WHEN op = 1 THEN 'request' WHEN op = 2 THEN 'reply' ELSE 'unknown' END AS operation,
       label, CASE WHEN label = 1 THEN 'simulated_attack' ELSE 'normal' END AS record_type
FROM packets""")
def label_union_v2(spark, sf_dir):
    normal, attack = _split(spark, sf_dir)
    return N.label_union(S.canonical_to_capture(normal), S.canonical_to_capture(attack),
                         with_record_type=True)


@register("seeded_shuffle", f"SELECT {_PKT_COLS}, label FROM packets")
def seeded_shuffle(spark, sf_dir):
    return N.seeded_shuffle(label_union_v1(spark, sf_dir), "seq", seed=42)


@register("class_distribution", """
SELECT label, count(*) AS count FROM packets GROUP BY label""")
def class_distribution(spark, sf_dir):
    return N.class_distribution(label_union_v1(spark, sf_dir), "label")


@register("record_type_distribution", """
SELECT CASE WHEN label = 1 THEN 'simulated_attack' ELSE 'normal' END AS record_type, count(*) AS count
FROM packets GROUP BY 1""")
def record_type_distribution(spark, sf_dir):
    return N.class_distribution(label_union_v2(spark, sf_dir), "record_type")


@register("anomaly_injection")  # seeded hash draws: rows-only check + pytest properties
def anomaly_injection(spark, sf_dir):
    normal = S.canonical_to_capture(fixture.packets_with_label(spark, sf_dir).where("label = 0"), keep=["seq"])
    recs = normal.select("seq", "timestamp", F.col("sender_ip"), F.col("sender_mac").alias("src_mac"),
                         "target_ip", "target_mac", F.lit(1).alias("op"))
    out = N.inject_anomalies(recs, n=4000, seed=42)
    return out.select("draw", "timestamp", "sender_ip", F.col("src_mac").alias("sender_mac"),
                      "target_ip", "target_mac",
                      F.when(F.col("op") == 2, "reply").otherwise("request").alias("operation"),
                      "label", "record_type")


@register("anomaly_injection_check", """
SELECT 4000 AS rows, 4000 AS spoofed, 4000 AS known_macs, 4000 AS normal_sources, 4000 AS labelled""")
def anomaly_injection_check(spark, sf_dir):
    """N7's properties: every row is a normal record whose MAC became another known one, a labelled reply."""
    normal = fixture.packets_with_label(spark, sf_dir).where("label = 0").drop("label")
    out = N.inject_anomalies(normal, n=4000, seed=42)
    source = normal.select("seq", F.col("src_mac").alias("own"), F.col("src_ip").alias("own_ip"), F.col("ts_us").alias("own_ts"))
    macs = normal.select(F.col("src_mac").alias("known")).distinct()
    x = (out.join(source, "seq", "left").join(macs, F.col("src_mac") == F.col("known"), "left"))
    return x.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("src_mac") != F.col("own")).alias("spoofed"),
                 F.count("known").alias("known_macs"),
                 F.count_if((F.col("own_ip") == F.col("src_ip")) & (F.col("own_ts") == F.col("ts_us"))).alias("normal_sources"),
                 F.count_if((F.col("label") == 1) & (F.col("op") == 2)
                            & (F.col("record_type") == "simulated_attack")).alias("labelled"))


@register("packet_features", """
SELECT seq,
       CASE WHEN op = 1 THEN 0 WHEN op = 2 THEN 1 END AS operation,
       CAST(coalesce(dst_ip = '0.0.0.0', false) AS INTEGER) AS is_unspecified_target,
       CAST(coalesce(lower(dst_mac) = 'ff:ff:ff:ff:ff:ff', false) AS INTEGER) AS is_broadcast_target,
       count(DISTINCT src_mac) OVER (PARTITION BY src_ip) AS macs_per_ip,
       count(*) OVER (PARTITION BY src_ip) AS sender_ip_frequency,
       CAST(hour(make_timestamp(ts_us)) AS INTEGER) AS hour,
       CAST(minute(make_timestamp(ts_us)) AS INTEGER) AS minute,
       CAST(second(make_timestamp(ts_us)) AS INTEGER) AS second
FROM packets""")
def packet_features(spark, sf_dir):
    return N.packet_features(fixture.packets(spark, sf_dir))
