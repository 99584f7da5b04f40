"""Canonical packet schema and the fixed values the analytics depend on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Canonical packet table.  Time is integer epoch microseconds so that range
# frames are exact; ``ts`` (timestamp) is derived where Spark wants one.
PACKET_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("ts_us", T.LongType(), False),
    T.StructField("op", T.IntegerType(), True),
    T.StructField("src_mac", T.StringType(), False),
    T.StructField("dst_mac", T.StringType(), True),
    T.StructField("src_ip", T.StringType(), False),
    T.StructField("dst_ip", T.StringType(), True),
])

US = 1_000_000

# ---------------------------------------------------------------------------
# Fixed values (must equal the documented behaviour for results to match)
# ---------------------------------------------------------------------------

# ARP operation codes.
OP_REQUEST = 1
OP_REPLY = 2

# Raw CSV columns of the ML packet dialect, in file order.
ML_PACKET_COLUMNS = ["timestamp", "op", "src_mac", "dst_mac", "src_ip", "dst_ip"]
# Columns of the capture dialect, in file order.
CAPTURE_COLUMNS = ["timestamp", "sender_ip", "sender_mac", "target_ip", "target_mac", "operation"]

# The ten window features, in model order.
MODEL_FEATURES = [
    "arp_request_count",
    "arp_reply_count",
    "reply_request_ratio",
    "unique_src_macs",
    "unique_src_ips",
    "unique_dst_ips",
    "ip_mac_pair_count",
    "max_packets_per_mac",
    "mac_ip_change_count",
    "unsolicited_reply_ratio",
]
RATIO_FEATURES = ["reply_request_ratio", "unsolicited_reply_ratio"]

DEFAULT_WINDOW_SECONDS = 30

# pandas' default NA tokens, read as null by the CSV contract.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

BROADCAST_MAC = "ff:ff:ff:ff:ff:ff"
UNSPECIFIED_IP = "0.0.0.0"

# Detection rule parameters.
DEFAULT_GATEWAYS = ["192.168.1.1", "10.0.0.1"]
CHANGE_WINDOW_S = 60          # rule 1 look-back
RAPID_CHANGES = 3             # rule 1: earlier changes that make it an attack
CLAIM_WINDOW_S = 60           # rule 2 look-back
CLAIMS_HIGH = 3               # rule 2: distinct MACs for HIGH
CLAIMS_CRITICAL = 5           # rule 2: distinct MACs for CRITICAL
RATE_WINDOW_S = 60            # rule 4 look-back
RATE_LIMIT = 50               # rule 4: packets above which HIGH
FLOOD_LIMIT = 100             # rule 4: packets above which CRITICAL flood
STORM_WINDOW_S = 30           # rule 5 look-back
STORM_TARGETS = 20            # rule 5: distinct targets above which it fires
RATE_STATE_CAP = 200          # observed mode: rate deque length
REQUEST_STATE_CAP = 100       # observed mode: request deque length

# Event types and severities.
EVENT_TYPES = [
    "IP_MAC_MAPPING_CHANGE", "DUPLICATE_IP_CLAIM", "UNUSUAL_ARP_ACTIVITY",
    "GATEWAY_MAPPING_CHANGE", "ARP_SPOOFING_ATTACK", "SUSPICIOUS_ARP_RATE",
    "MAC_FLOODING", "ARP_REQUEST_STORM",
]
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO"]

# Risk model.
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
RULE_WEIGHTS = {
    "mac_ip_change": 30,
    "ip_mac_conflict": 25,
    "unsolicited_reply": 20,
    "duplicate_ip": 20,
    "high_arp_rate": 10,
    "unknown_device": 10,
    "gateway_mapping_change": 35,
}
RULE_SHARE = 0.60
ML_SHARE = 0.40
AGREEMENT_BONUS = 10.0
TRUSTED_FACTOR = 0.90
SAFE_ACTIONS = ["ALERT_ADMIN", "MARK_DEVICE_UNTRUSTED", "ISOLATE_DEVICE", "REFRESH_ARP_BASELINE"]
INCIDENT_SOURCE = "ARP_MONITOR"
INCIDENT_TYPE = "ARP_ANOMALY"

# Isolation forest defaults.
FOREST_TREES = 100
FOREST_CONTAMINATION = 0.05
FOREST_SEED = 42
FOREST_MAX_SAMPLES = 256


class ContractError(ValueError):
    """Raised when an input does not carry the columns an operator needs."""


def require_columns(df: DataFrame, columns, what: str = "input") -> DataFrame:
    """Fail fast (driver-side, schema only) if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(
            f"{what} is missing required columns {missing}; found {df.columns}")
    return df
