"""Exact money.

A sum of doubles depends on the order in which tasks finish. Amounts are
therefore carried as whole millionths in BIGINT: exact, order-free, and a plain
long in generated code. Rounded quotients use integer half-up division. ANSI
mode turns an overflow into an error; totals over whole tables are summed as
DECIMAL (`wide_sum`) so that they cannot reach it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
MICROS_PER_CENT = 10_000


def to_micros(amount: Column) -> Column:
    """Nearest whole millionth of a numeric amount."""
    return F.floor(amount.cast("double") * F.lit(float(MICROS)) + F.lit(0.5))


def wide_sum(micros: Column) -> Column:
    """Sum for groups that may span a large share of the whole table."""
    return F.sum(micros.cast("decimal(20,0)"))


def int_div(numerator: Column, denominator: Column) -> Column:
    """Whole-number division of BIGINT or DECIMAL columns, as BIGINT."""
    return F.call_function("div", numerator, denominator)


def div_half_up(numerator: Column, denominator: Column) -> Column:
    """Nearest whole quotient, halves up; both arguments non-negative."""
    return int_div(numerator * 2 + denominator, denominator * 2)


def dollars(micros: Column) -> Column:
    """Amount rounded to cents."""
    return div_half_up(micros, F.lit(MICROS_PER_CENT)) / F.lit(100.0)


def dollars_unrounded(micros: Column) -> Column:
    return micros.cast("double") / F.lit(float(MICROS))


def mean_dollars(micros: Column, count: Column) -> Column:
    """Average amount rounded to cents; NULL when the count is zero."""
    return F.when(count > 0, div_half_up(micros, count * MICROS_PER_CENT) / F.lit(100.0))


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """part / whole for whole numbers, rounded; NULL when whole is zero."""
    scale = 10**places
    return F.when(whole > 0, div_half_up(part * scale, whole) / F.lit(float(scale)))


def round_double(value: Column, places: int) -> Column:
    """Half-up rounding of a non-negative double in plain IEEE arithmetic."""
    scale = float(10**places)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def safe_divide(numerator: Column, denominator: Column, fill: float = 0.0) -> Column:
    """Division that yields `fill` where the denominator is zero or missing."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(fill))
