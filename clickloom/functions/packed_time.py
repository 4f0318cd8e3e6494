"""Packed click times: one integer ``DDHHMM`` (day, hour, minute) without a month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(numerator: Column, divisor: int) -> Column:
    """Integer quotient, truncated toward zero."""
    return F.call_function("div", numerator, F.lit(divisor))


def hour_of(packed: Column) -> Column:
    return (whole(packed, 100) % 100).cast("int")


def day_of(packed: Column) -> Column:
    return whole(packed, 10000).cast("int")


def minute_of_month(packed: Column) -> Column:
    """Minutes since the start of day 0."""
    packed = packed.cast("long")
    return whole(packed, 10000) * 1440 + whole(packed, 100) % 100 * 60 + packed % 100


def delay_minutes(clicked: Column, converted: Column) -> Column:
    """True minutes between click and conversion; null when not converted."""
    return minute_of_month(converted) - minute_of_month(clicked)


def delay_minutes_compat(clicked: Column, converted: Column) -> Column:
    """Delay as historically published: digits of the plain difference, hours weighted 24.

    Day and hour digits are floored and remainders non-negative, so that a
    borrow across a day or hour shows up exactly as it does in old tables.
    """
    gap = (converted - clicked).cast("double")
    days = F.floor(gap / 10000)
    hours = F.floor(F.pmod(gap / 100, F.lit(100.0)))
    minutes = F.floor(F.pmod(gap, F.lit(100.0)))
    return (days * 1440 + hours * 24 + minutes).cast("double")


def pack(ts: Column) -> Column:
    """``DDHHMM`` of a timestamp."""
    return F.dayofmonth(ts) * 10000 + F.hour(ts) * 100 + F.minute(ts)
