"""Numbers: values that must survive bad input, and the load-time rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_or_null(column: Column) -> Column:
    """Whole number truncated toward zero; NULL for NaN, out-of-range and unparseable values."""
    return column.try_cast("int")


def double_or_null(column: Column) -> Column:
    """Double; NULL for NaN and unparseable values."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def false_if_null(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def stored_hours(hours: Column) -> Column:
    """Hours as the fact keeps them: two decimals, halves away from zero."""
    return double_or_null(hours).cast("decimal(10,2)")


def rounded_average(column: Column) -> Column:
    """Average of decimals ignoring NULLs, to one decimal, as double.

    Sum by count keeps 20 decimals until the only rounding; the built-in average of a
    decimal would round to six first and could lift a value just below a half over it.
    """
    return F.round(F.try_divide(F.sum(column), F.count(column)), 1).cast("double")
