"""Strings: trimming, blank handling, and the texts shown in reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicflow import contracts

SIZE_UNITS = contracts.SIZE_UNITS


def blank_to_null(column: Column) -> Column:
    """The text without leading and trailing spaces, or NULL when nothing is left.

    Only spaces are trimmed; tabs and line breaks count as text.
    """
    return F.nullif(F.trim(column), F.lit(""))


def is_present(column: Column) -> Column:
    """True for a usable natural-key part: neither NULL nor empty."""
    return column.isNotNull() & (column != "")


def percent_text(rate: Column) -> Column:
    """A ratio as a whole percentage; exact halves go to the even number."""
    return F.format_string("%.0f%%", F.bround(rate * 100.0, 0))


def human_size(size: Column) -> Column:
    """A byte count with one decimal in the largest 1024-step unit that keeps it below 1024.

    Exact halves go to the even digit.
    """
    value = size.cast("double")

    def in_unit(power: int) -> Column:
        return F.format_string("%.1f" + SIZE_UNITS[power], F.bround(value / 1024.0**power, 1))

    text = in_unit(len(SIZE_UNITS) - 1)
    for power in reversed(range(len(SIZE_UNITS) - 1)):
        text = F.when(value < 1024.0 ** (power + 1), in_unit(power)).otherwise(text)
    return text
