"""Time arithmetic. All functions assume the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: str, end: str) -> Column:
    """Whole seconds; each end is cut to its second first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: str, end: str) -> Column:
    return seconds_between(start, end) / 60


def local_clock(utc: str, zone: str) -> Column:
    return F.from_utc_timestamp(utc, zone)


def on_weekend(moment: Column) -> Column:
    """Saturday or Sunday; false, not null, for a missing time."""
    return F.coalesce(F.dayofweek(moment).isin(1, 7), F.lit(False))
