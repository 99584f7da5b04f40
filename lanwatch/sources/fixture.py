"""Packet view over the driver's ``events`` table (see FIXTURES.md §2).

The same text runs in Spark SQL and in DuckDB, so the oracle queries embed it
as a CTE and the Spark side reads it through ``spark.sql`` with a DataFrame
parameter.  Each block of 1,000 events carries one of every attack situation.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Fixed text of the packet view; ``{events}`` is the events table.
PACKET_VIEW_SQL = """
SELECT seq, ts_us, op, src_mac,
       CASE WHEN op = 1 THEN 'ff:ff:ff:ff:ff:ff' ELSE '02:00:00:00:01:' || lpad(k, 2, '0') END AS dst_mac,
       src_ip, dst_ip, label
FROM (
  SELECT event_id AS seq,
    1700000000000000 + event_id * 100000 AS ts_us,
    k,
    CASE WHEN b BETWEEN 100 AND 179 OR b BETWEEN 500 AND 507 OR b BETWEEN 800 AND 929 THEN 1
         WHEN b BETWEEN 300 AND 320 THEN 2
         WHEN event_type IN ('view', 'click', 'signup') THEN 1 ELSE 2 END AS op,
    CASE WHEN b BETWEEN 100 AND 179 THEN '02:00:00:00:ff:01'
         WHEN b BETWEEN 300 AND 320 AND b % 2 = 1 THEN '02:00:00:00:ff:02'
         WHEN b BETWEEN 300 AND 320 THEN '02:00:00:00:00:fe'
         WHEN b BETWEEN 500 AND 507 THEN '02:00:00:00:aa:' || lpad(CAST(b - 500 AS STRING), 2, '0')
         WHEN b BETWEEN 800 AND 929 THEN '02:00:00:00:ff:03'
         ELSE '02:00:00:' || lpad(CAST(CAST((user_id - user_id % 100) / 100 AS INT) AS STRING), 2, '0')
              || ':02:' || lpad(CAST(user_id % 100 AS STRING), 2, '0') END AS src_mac,
    CASE WHEN b BETWEEN 100 AND 179 THEN '192.168.1.100'
         WHEN b BETWEEN 300 AND 320 THEN '192.168.1.1'
         WHEN b BETWEEN 500 AND 507 THEN '192.168.1.50'
         WHEN b BETWEEN 800 AND 929 THEN '192.168.3.' || CAST(b - 800 AS STRING)
         WHEN b = 700 THEN '0.0.0.0'
         ELSE '10.0.' || CAST(CAST((user_id - user_id % 250) / 250 AS INT) AS STRING)
              || '.' || CAST(user_id % 250 AS STRING) END AS src_ip,
    CASE WHEN b BETWEEN 100 AND 179 THEN '192.168.2.' || CAST(b AS STRING)
         ELSE '192.168.1.' || k END AS dst_ip,
    CASE WHEN b BETWEEN 100 AND 179 OR (b BETWEEN 300 AND 320 AND b % 2 = 1)
           OR b BETWEEN 500 AND 507 OR b BETWEEN 800 AND 929 THEN 1 ELSE 0 END AS label
  FROM (SELECT event_id, event_type, user_id, event_id % 1000 AS b,
               regexp_extract(props, '[0-9]+', 0) AS k FROM {events}) e0
) e1
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def packets_with_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical packets plus the ground-truth ``label`` column."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "props")
    df = spark.sql(PACKET_VIEW_SQL, events=events)
    return df.selectExpr("seq", "ts_us", "CAST(op AS INT) AS op", "src_mac",
                         "dst_mac", "src_ip", "dst_ip", "CAST(label AS INT) AS label")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_with_label(spark, sf_dir).drop("label")


def oracle_view(select_sql: str, extra_ctes: str = "") -> str:
    """Wrap an oracle query so that ``packets`` is the fixture view (DuckDB)."""
    view = PACKET_VIEW_SQL.replace("{events}", "events")
    body = (
        "WITH packets_raw AS (" + view + "),\n"
        "packets AS (SELECT seq, ts_us, CAST(op AS INTEGER) AS op, src_mac, dst_mac, src_ip, dst_ip,"
        " CAST(label AS INTEGER) AS label FROM packets_raw)"
    )
    if extra_ctes:
        body += ",\n" + extra_ctes
    return body + "\n" + select_sql
