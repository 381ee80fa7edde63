"""Expressions on epoch milliseconds. Integer arithmetic: no time zone, no overflow."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 86_400_000
# Last millisecond of the year 9999.
MAX_MS = 253_402_300_799_999


def floor_to(ms: Column, size_ms: int) -> Column:
    return ms - F.pmod(ms, F.lit(size_ms).cast("long"))


def hour_of_day(ms: Column) -> Column:
    return F.floor(F.pmod(ms, F.lit(DAY_MS).cast("long")) / F.lit(HOUR_MS)).cast("int")


def utc_date(ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(ms / F.lit(DAY_MS)).cast("int"))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def as_millis(value: int | Column | None) -> Column:
    """A point in time given as a number, a column, or None for now."""
    if value is None:
        return now_ms()
    return value if isinstance(value, Column) else F.lit(value).cast("long")
