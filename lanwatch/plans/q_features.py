"""Queries for window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as W
from ..schema import MODEL_FEATURES
from ..sources import fixture
from .catalog import r6, register

W_US = 30_000_000

_BINNED = f"""
b AS (SELECT min(ts_us) AS lo, max(ts_us) AS hi FROM packets),
grid AS (SELECT unnest(range(0, (hi - lo) // {W_US} + 1 + CASE WHEN (hi - lo) % {W_US} > 0 THEN 1 ELSE 0 END)) AS bin, lo FROM b),
pk AS (SELECT p.*, (p.ts_us - b.lo) // {W_US} AS bin FROM packets p, b),
agg AS (
  SELECT bin, count(*) AS total,
         count(*) FILTER (WHERE op = 1) AS req,
         count(*) FILTER (WHERE op = 2) AS rep,
         count(DISTINCT src_mac) AS macs, count(DISTINCT src_ip) AS ips,
         count(DISTINCT dst_ip) AS dsts, count(DISTINCT (src_ip, src_mac)) AS pairs
  FROM pk GROUP BY bin),
per_mac AS (SELECT bin, src_mac, count(*) AS c, count(DISTINCT src_ip) AS n_ip FROM pk GROUP BY bin, src_mac),
mx AS (SELECT bin, max(c) AS mx, CAST(sum(n_ip - 1) AS BIGINT) AS chg FROM per_mac GROUP BY bin),
wf AS (
  SELECT g.bin, CAST(g.lo + g.bin * {W_US} AS DOUBLE) / 1e6 AS window_start,
         coalesce(a.req, 0) AS arp_request_count,
         coalesce(a.rep, 0) AS arp_reply_count,
         round(coalesce(a.rep, 0) / greatest(coalesce(a.req, 0), 1), 6) AS reply_request_ratio,
         coalesce(a.macs, 0) AS unique_src_macs,
         coalesce(a.ips, 0) AS unique_src_ips,
         coalesce(a.dsts, 0) AS unique_dst_ips,
         coalesce(a.pairs, 0) AS ip_mac_pair_count,
         coalesce(m.mx, 0) AS max_packets_per_mac,
         coalesce(m.chg, 0) AS mac_ip_change_count,
         round(greatest(coalesce(a.rep, 0) - coalesce(a.req, 0), 0) / greatest(coalesce(a.total, 0), 1), 6)
           AS unsolicited_reply_ratio
  FROM grid g LEFT JOIN agg a ON a.bin = g.bin LEFT JOIN mx m ON m.bin = g.bin)"""

FEATURE_LIST = ", ".join(MODEL_FEATURES)


@register("window_features", f"SELECT window_start, {FEATURE_LIST} FROM wf", _BINNED)
def window_features(spark, sf_dir):
    return W.engineer_features(fixture.packets(spark, sf_dir))


_SUMMARY_UNION = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM wf"
    for c in MODEL_FEATURES)


@register("feature_summary", _SUMMARY_UNION, _BINNED)
def feature_summary(spark, sf_dir):
    s = W.feature_summary(window_features(spark, sf_dir))
    return s.select("feature", r6("mean").alias("mean"), r6("std").alias("std"),
                    r6("min").alias("min"), r6("max").alias("max"))


@register("time_range", """
SELECT count(*) AS packets, min(ts_us) / 1e6 AS first_ts, max(ts_us) / 1e6 AS last_ts,
       (max(ts_us) - min(ts_us)) / 1e6 AS duration_s FROM packets""")
def time_range(spark, sf_dir):
    return W.time_range(fixture.packets(spark, sf_dir))
