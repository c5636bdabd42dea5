"""Epoch milliseconds to local day and hour at a fixed UTC offset.

Plain integer arithmetic: the session time zone cannot change the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# Fixed value: events are bucketed in UTC+8 unless a job says otherwise.
DEFAULT_UTC_OFFSET_HOURS = 8

# Largest magnitude of epoch milliseconds whose microseconds fit in 64 bits.
MAX_EPOCH_MS = 9_223_372_036_854_775


def in_supported_range(epoch_ms: Column) -> Column:
    return epoch_ms.between(-MAX_EPOCH_MS, MAX_EPOCH_MS)


def local_day(epoch_ms: Column, utc_offset_hours: int = DEFAULT_UTC_OFFSET_HOURS) -> Column:
    local_ms = epoch_ms + F.lit(utc_offset_hours * HOUR_MS)
    days = F.call_function("div", local_ms - F.pmod(local_ms, F.lit(DAY_MS)), F.lit(DAY_MS))
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def local_hour(epoch_ms: Column, utc_offset_hours: int = DEFAULT_UTC_OFFSET_HOURS) -> Column:
    local_ms = epoch_ms + F.lit(utc_offset_hours * HOUR_MS)
    return F.call_function("div", F.pmod(local_ms, F.lit(DAY_MS)), F.lit(HOUR_MS)).cast("int")
