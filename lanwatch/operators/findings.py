"""Findings per (window, device) from rule detections and window features.

The rule engine and the risk model use different vocabularies; this adapter
is ours.  Mapping (fixed values):

* GATEWAY_MAPPING_CHANGE                            -> gateway_mapping_change
* IP_MAC_MAPPING_CHANGE, ARP_SPOOFING_ATTACK        -> mac_ip_change
* DUPLICATE_IP_CLAIM                                -> duplicate_ip
* UNUSUAL_ARP_ACTIVITY, MAC_FLOODING, ARP_REQUEST_STORM -> high_arp_rate
* sender IP seen with more than one MAC in the window -> ip_mac_conflict
* the window's unsolicited_reply_ratio              -> unsolicited_reply (confidence)
* device not in the trust list                      -> unknown_device (added with trust)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import UNSPECIFIED_IP, US

FINDING_EVENTS = {
    "gateway_mapping_change": ["GATEWAY_MAPPING_CHANGE"],
    "mac_ip_change": ["IP_MAC_MAPPING_CHANGE", "ARP_SPOOFING_ATTACK"],
    "duplicate_ip": ["DUPLICATE_IP_CLAIM"],
    "high_arp_rate": ["UNUSUAL_ARP_ACTIVITY", "MAC_FLOODING", "ARP_REQUEST_STORM"],
}
FLAG_NAMES = list(FINDING_EVENTS) + ["ip_mac_conflict"]


def _bin(ts: str, lo: int, w_us: int):
    return F.expr(f"(`{ts}` - {int(lo)}) div {int(w_us)}")


def findings_from_detections(detections: DataFrame, packets: DataFrame, lo: int,
                             window_features: DataFrame | None = None,
                             window_seconds: float = 30) -> DataFrame:
    """One row per (bin, device_mac, device_ip) with at least one detection.

    ``lo`` is the window grid anchor (first packet time, as for features).
    ``packets`` serve the conflicts only: ``rules.contested_packets`` will do.
    ``window_features`` (with ``bin``) supplies the unsolicited-reply ratio.
    """
    w_us = int(round(window_seconds * US))
    d = detections.withColumn("bin", _bin("ts_us", lo, w_us))
    flags = d.groupBy("bin", "device_mac", "device_ip").agg(
        *[F.bool_or(F.col("event_type").isin(evts)).alias(name) for name, evts in FINDING_EVENTS.items()])
    conflicts = (packets.where(F.col("src_ip") != UNSPECIFIED_IP)
                 .withColumn("bin", _bin("ts_us", lo, w_us))
                 .groupBy("bin", "src_ip", "src_mac").agg(F.count(F.lit(1)).alias("_n"))
                 .groupBy("bin", "src_ip").agg(F.count(F.lit(1)).alias("_macs"))
                 .where(F.col("_macs") > 1)
                 .select("bin", F.col("src_ip").alias("device_ip"), F.lit(True).alias("ip_mac_conflict")))
    out = flags.join(conflicts, ["bin", "device_ip"], "left").withColumn(
        "ip_mac_conflict", F.coalesce("ip_mac_conflict", F.lit(False)))
    if window_features is not None:
        out = out.join(window_features.select("bin", F.col("unsolicited_reply_ratio").alias("unsolicited_reply")),
                       "bin", "left")
    else:
        out = out.withColumn("unsolicited_reply", F.lit(None).cast("double"))
    return out.select(
        "bin", ((F.lit(lo) + F.col("bin") * F.lit(w_us)).cast("double") / F.lit(1e6)).alias("window_start"),
        "device_mac", "device_ip", *FLAG_NAMES, "unsolicited_reply")


def event_key():
    """Key of a finding: absolute window start, device MAC and IP (the same for batches and streams)."""
    return F.concat_ws("|", F.round(F.col("window_start") * 1e6).cast("long").cast("string"), "device_mac",
                       F.coalesce("device_ip", F.lit("")))


def as_maps(findings: DataFrame, extra_flags: dict | None = None) -> DataFrame:
    """Pack flag columns into ``flags`` (name -> bool) and ``confidence`` maps."""
    names = list(FLAG_NAMES) + list((extra_flags or {}).keys())
    vals = [F.col(n) for n in FLAG_NAMES] + list((extra_flags or {}).values())
    return findings.withColumns({
        "flags": F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*vals)),
        "confidence": F.when(F.col("unsolicited_reply").isNotNull(),
                             F.create_map(F.lit("unsolicited_reply"), F.col("unsolicited_reply").cast("double")))
                       .otherwise(F.create_map().cast("map<string,double>")),
    })
