"""Day arithmetic on ``yyyy-MM-dd`` strings, independent of the session time zone."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
DASHED = "yyyy-MM-dd"
COMPACT = "yyyyMMdd"


def shift(day: str, days_back: int) -> str:
    """The day ``days_back`` days before ``day``, for plan-time literals."""
    return (date.fromisoformat(day) - timedelta(days=days_back)).isoformat()


def compact(day: str) -> str:
    return day.replace("-", "")


def bounds_ms(day: str, utc_offset_hours: int = 0) -> tuple[int, int]:
    """First and last epoch millisecond of ``day`` as plan-time literals."""
    start = (date.fromisoformat(day) - date(1970, 1, 1)).days * DAY_MS
    start -= utc_offset_hours * HOUR_MS
    return start, start + DAY_MS - 1


def days_before(day: Column, n: int | Column, fmt: str = DASHED) -> Column:
    return F.date_format(F.date_sub(F.to_date(day, DASHED), n), fmt)


def day_start_ms(day: Column, utc_offset_hours: int = 0) -> Column:
    since_epoch = F.datediff(F.to_date(day, DASHED), F.lit("1970-01-01").cast("date"))
    return since_epoch.cast("bigint") * DAY_MS - F.lit(utc_offset_hours * HOUR_MS)


def day_end_ms(day: Column, utc_offset_hours: int = 0) -> Column:
    return day_start_ms(day, utc_offset_hours) + F.lit(DAY_MS - 1)


def compact_day(day: Column) -> Column:
    return F.replace(day, F.lit("-"), F.lit(""))


def expand_day(day: Column) -> Column:
    return F.date_format(F.to_date(day, COMPACT), DASHED)


def age_in_days(compact_day_col: Column, day: str) -> Column:
    """Days from a ``yyyyMMdd`` column to ``day``; null when it does not parse."""
    parsed = F.try_to_date(compact_day_col, COMPACT)
    return F.datediff(F.lit(day).cast("date"), parsed)
