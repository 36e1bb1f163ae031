"""Column functions on dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_between(start: Column, stop: Column) -> Column:
    """Signed minutes as a fraction, to the microsecond."""
    return F.timestamp_diff("MICROSECOND", start, stop) / F.lit(60_000_000.0)


def local_time(ts: Column, zone: Column) -> Column:
    """UTC timestamp to the wall clock of a per-row zone, UTC where the zone is missing."""
    return F.from_utc_timestamp(ts, F.coalesce(zone, F.lit("UTC")))


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def in_clock_band(ts: Column, start: str, stop: str) -> Column:
    """Time of day in [start, stop]; a band whose start is after its stop wraps over midnight."""
    tm = clock(ts)
    return ((tm >= start) | (tm <= stop)) if start > stop else tm.between(start, stop)


def in_days(ts: Column, first: str, last: str) -> Column:
    """From `first` to the end of the day `last`, written as a half-open range so that it is pushed down."""
    low = F.lit(first).cast("timestamp_ntz")
    high = (F.lit(last).cast("date") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz")
    return (ts >= low) & (ts < high)


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def hours_of(day: str) -> Column:
    """The 24 hour starts of a day, as an array."""
    start = F.lit(day).cast("timestamp_ntz")
    return F.sequence(start, start + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))
