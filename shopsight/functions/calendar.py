"""Months and day counts. All calendar boundaries are UTC (see `session.tune`)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopsight.functions.money import div_half_up

MICROS_PER_DAY = 86_400_000_000


def month_of(ts: Column) -> Column:
    return F.trunc(ts, "month")


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def months_between(later: Column, earlier: Column) -> Column:
    """Number of calendar month boundaries between two dates."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("bigint")


def at_micros(micros: int) -> Column:
    """Timestamp literal from microseconds since the epoch."""
    return F.timestamp_micros(F.lit(micros))


def elapsed_micros(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Fractional days."""
    return elapsed_micros(later, earlier).cast("double") / F.lit(float(MICROS_PER_DAY))


def elapsed_days_tenths(later: Column, earlier: Column) -> Column:
    """Fractional days rounded to one decimal."""
    tenths = div_half_up(elapsed_micros(later, earlier) * 10, F.lit(MICROS_PER_DAY))
    return tenths / F.lit(10.0)
