"""Tolerant parsing: a value that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.contracts import DATE_FORMATS


def timestamp(col: str, dtype: T.DataType) -> Column:
    """ISO forms first, then DATE_FORMATS."""
    if isinstance(dtype, T.StringType):
        others = [F.try_to_timestamp(F.col(col), F.lit(form)) for form in DATE_FORMATS]
        return F.coalesce(F.try_to_timestamp(F.col(col)), *others)
    return F.col(col).cast("timestamp")


def number(col: str, dtype: T.DataType) -> Column:
    """DOUBLE value; text that is no number, and NaN, become NULL."""
    if isinstance(dtype, (T.StringType, T.FloatType, T.DoubleType)):
        value = F.col(col).try_cast("double")
        return F.when(~F.isnan(value), value)
    return F.col(col).cast("double")


def label(col: str) -> Column:
    return F.trim(F.col(col).cast("string"))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
