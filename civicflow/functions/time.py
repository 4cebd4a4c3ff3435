"""Instants and calendar dates. The session time zone is UTC (see ``session.configure``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_ms(column: Column) -> Column:
    return F.timestamp_millis(column)


def to_epoch_ms(column: Column) -> Column:
    """Epoch milliseconds of a timestamp, with or without time zone."""
    return F.unix_millis(column.cast("timestamp"))


def to_epoch_seconds(column: Column) -> Column:
    """Whole epoch seconds, rounded down."""
    return column.cast("timestamp").cast("long")


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours as double, from whole seconds; NULL when either end is missing."""
    return (to_epoch_seconds(end) - to_epoch_seconds(start)) / F.lit(3600.0).cast("double")


def date_key(column: Column) -> Column:
    """Calendar day as the integer YYYYMMDD."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("int")


def date_attributes(day: Column) -> dict[str, Column]:
    """Columns of the date dimension; weeks count from Sunday = 0."""
    weekday = F.dayofweek(day) - 1
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": weekday,
        "is_weekend": weekday.isin(0, 6),
    }


def landing_partition(run_at: Column) -> dict[str, Column]:
    """Zero-padded year, month and day of a run, as the landing directories spell them."""
    return {
        "ingest_year": F.date_format(run_at, "yyyy"),
        "ingest_month": F.date_format(run_at, "MM"),
        "ingest_day": F.date_format(run_at, "dd"),
    }


def utc_iso(column: Column) -> Column:
    """ISO-8601 text of an instant in UTC, to the microsecond."""
    in_utc = F.to_utc_timestamp(column.cast("timestamp"), F.current_timezone())
    return F.date_format(in_utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def utc_seconds_text(column: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of an instant in UTC, cut to whole seconds."""
    in_utc = F.to_utc_timestamp(column.cast("timestamp"), F.current_timezone())
    return F.date_format(in_utc, "yyyy-MM-dd HH:mm:ss")
