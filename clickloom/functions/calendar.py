"""Calendar arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.packed_time import whole


def ntz(text: str) -> Column:
    """Timestamp literal without a zone."""
    return F.lit(text).cast("timestamp_ntz")


def parse(text: Column) -> Column:
    return text.cast("timestamp_ntz")


def at_hour(date: Column, hour: Column) -> Column:
    """Timestamp of a date and an hour of day."""
    return plus_seconds(date.cast("timestamp_ntz"), hour.cast("long") * 3600)


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970 (zone-free)."""
    return F.timestamp_diff("SECOND", ntz("1970-01-01 00:00:00"), ts)


def from_epoch(seconds: Column) -> Column:
    return plus_seconds(ntz("1970-01-01 00:00:00"), seconds)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def bin_start(ts: Column, step: int) -> Column:
    """Start of the left-closed bin of ``step`` seconds, aligned to midnight."""
    seconds = epoch(ts)
    return from_epoch(seconds - F.pmod(seconds, F.lit(step)))


def slot_of_day(ts: Column, minutes: int = 20) -> Column:
    return whole(F.hour(ts) * 60 + F.minute(ts), minutes).cast("int")


def monday_first(ts: Column) -> Column:
    """Day of week, Monday = 0."""
    return F.weekday(ts)


def hour_in(ts: Column, *ranges: tuple[int, int]) -> Column:
    """True in any half-open hour range, e.g. ``(8, 10), (17, 19)``."""
    hour = F.hour(ts)
    hit = F.lit(False)
    for begin, end in ranges:
        hit = hit | ((hour >= begin) & (hour < end))
    return hit


def in_days(ts: Column, first: str, last: str) -> Column:
    """True from the start of day ``first`` to the end of day ``last``."""
    return (ts >= ntz(first)) & (ts < ntz(last) + F.expr("INTERVAL '1' DAY"))
