"""Time buckets over zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = ("daily", "monthly")
NO_MONTH = "none"


def hour_floor(ts: Column) -> Column:
    """Start of the hour. Built from date and hour, which no session time zone can shift."""
    day = ts.cast("date").cast("timestamp_ntz")
    return day + F.make_dt_interval(hours=F.hour(ts))


def hour_number(ts: Column) -> Column:
    """Whole hours since 1970-01-01 as bigint: consecutive hours differ by one."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)


def hour_start(number: Column) -> Column:
    """The timestamp of an hour number; inverse of ``hour_number``."""
    hour = F.pmod(number, F.lit(24))
    day = F.date_from_unix_date(((number - hour) / 24).cast("int")).cast("timestamp_ntz")
    return day + F.make_dt_interval(hours=hour.cast("int"))


def period(ts: Column, frequency: str) -> Column:
    """Text label of the day (2026-01-31) or month (2026-01)."""
    if frequency not in PERIODS:
        raise ValueError("frequency must be 'daily' or 'monthly'")
    day = ts.cast("date").cast("string")
    return day if frequency == "daily" else F.substring(day, 1, 7)


def month_label(ts: Column) -> Column:
    """Text label of the month, ``none`` for a missing timestamp: the name of the month's folder."""
    return F.coalesce(F.date_format(F.trunc(ts, "month"), "yyyy-MM"), F.lit(NO_MONTH))


def month_number(year: Column, month: Column) -> Column:
    """Year and month as one sortable integer, 202601 for January 2026."""
    return year * 100 + month
