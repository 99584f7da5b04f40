"""Address helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_mac(mac: Column) -> Column:
    """Strip surrounding whitespace, lower-case, '-' -> ':'."""
    stripped = F.regexp_replace(mac, r"^\s+|\s+$", "")
    return F.regexp_replace(F.lower(stripped), "-", ":")
