"""Time helpers that do not depend on the session time zone.

Packet time is epoch microseconds; text forms and clock parts are always
rendered in UTC, whatever ``spark.sql.session.timeZone`` is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def utc_text(ts_us: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch microseconds -> UTC wall-clock text."""
    inst = F.timestamp_micros(ts_us)
    return F.date_format(F.to_utc_timestamp(inst, F.current_timezone()), fmt)


def utc_parse_us(text: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """UTC wall-clock text -> epoch microseconds (null when unparsable)."""
    local = F.try_to_timestamp(text, F.lit(fmt))
    return F.unix_micros(F.from_utc_timestamp(local, F.current_timezone()))


def utc_hour(ts_us: Column) -> Column:
    return (F.pmod(ts_us, F.lit(DAY_US)) / F.lit(3_600_000_000)).cast("int")


def utc_minute(ts_us: Column) -> Column:
    return (F.pmod(ts_us, F.lit(3_600_000_000)) / F.lit(60_000_000)).cast("int")


def utc_second(ts_us: Column) -> Column:
    return (F.pmod(ts_us, F.lit(60_000_000)) / F.lit(1_000_000)).cast("int")
