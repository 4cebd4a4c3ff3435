"""Row flags derived from the case fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicflow import contracts


def likely_internal(
    source: Column,
    summary: Column,
    source_pattern: str = contracts.INTERNAL_SOURCE_PATTERN,
    summary_pattern: str = contracts.INTERNAL_SUMMARY_PATTERN,
) -> Column:
    """Whether a case looks like an internal mailbox notice.

    Three-valued: NULL when one field is missing and the other does not match.
    """
    return source.rlike(source_pattern) | summary.rlike(summary_pattern)


def inside_box(
    latitude: Column,
    longitude: Column,
    latitude_range: tuple[float, float] = contracts.LATITUDE_RANGE,
    longitude_range: tuple[float, float] = contracts.LONGITUDE_RANGE,
) -> Column:
    """Whether a point lies in the box, edges included; missing coordinates are outside."""
    within = latitude.between(*latitude_range) & longitude.between(*longitude_range)
    return F.coalesce(within, F.lit(False))


def closed_too_early(created_at: Column, closed_at: Column) -> Column:
    """True where a case closed before it was created; false for open cases."""
    return F.coalesce(closed_at < created_at, F.lit(False))
