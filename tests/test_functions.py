from __future__ import annotations

import math
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from civicflow.functions import flags, numbers, text, time


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_blank_to_null_trims_spaces_only(spark):
    df = spark.createDataFrame([("  a b ",), ("   ",), ("",), (None,), ("\t",)], "s string")
    got = [r["t"] for r in df.select(text.blank_to_null(F.col("s")).alias("t")).collect()]
    assert got == ["a b", None, None, None, "\t"]


def test_presence_is_false_for_null_and_empty(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "s string")
    assert [r[0] for r in df.where(text.is_present(F.col("s"))).collect()] == ["a"]


@pytest.mark.parametrize("size", [0, 1, 1023, 1024, 1280, 1792, 5_000_000, 1024**3, 3 * 1024**4, 2**60, 1023.95 * 1024])
def test_human_size_matches_python_formatting(spark, size):
    value, expected = float(size), None
    for unit in ["B", "KB", "MB", "GB"]:
        if value < 1024:
            expected = f"{value:.1f}{unit}"
            break
        value /= 1024
    expected = expected or f"{value:.1f}TB"
    assert one(spark, t=text.human_size(F.lit(float(size))))["t"] == expected


@pytest.mark.parametrize("rate", [0.0, 0.005, 0.125, 0.135, 0.285, 0.4, 0.999, 1.0])
def test_percent_text_matches_python_formatting(spark, rate):
    assert one(spark, t=text.percent_text(F.lit(rate)))["t"] == f"{rate:.0%}"


def test_epoch_milliseconds_are_utc_instants(spark):
    row = one(
        spark,
        ms=time.to_epoch_ms(time.from_epoch_ms(F.lit(1_710_000_000_123))),
        text=time.utc_iso(time.from_epoch_ms(F.lit(1_710_000_000_123))),
        null=time.from_epoch_ms(F.lit(None).cast("long")),
    )
    expected = datetime.fromtimestamp(1_710_000_000.123, tz=timezone.utc)
    assert row["ms"] == 1_710_000_000_123
    assert row["text"] == expected.isoformat()
    assert row["null"] is None


def test_epoch_seconds_round_down(spark):
    row = one(
        spark,
        after=time.to_epoch_seconds(F.timestamp_millis(F.lit(1999))),
        before=time.to_epoch_seconds(F.timestamp_millis(F.lit(-1))),
    )
    assert (row["after"], row["before"]) == (1, -1)


def test_hours_between_uses_whole_seconds_and_may_be_negative(spark):
    start, end = F.timestamp_millis(F.lit(1_000)), F.timestamp_millis(F.lit(5_400_999))
    row = one(spark, forth=time.hours_between(start, end), back=time.hours_between(end, start))
    assert row["forth"] == pytest.approx(5399 / 3600)
    assert row["back"] == -row["forth"]


def test_texts_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = F.timestamp_millis(F.lit(1_710_000_000_000))
        row = one(spark, iso=time.utc_iso(at), seconds=time.utc_seconds_text(at))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["iso"] == "2024-03-09T16:00:00.000000+00:00"
    assert row["seconds"] == "2024-03-09 16:00:00"


@pytest.mark.parametrize("day", [date(2026, 8, 17), date(2026, 8, 15), date(2026, 8, 16), date(2026, 1, 5)])
def test_date_attributes(spark, day):
    row = one(spark, **time.date_attributes(F.lit(day)))
    assert row["date_key"] == int(day.strftime("%Y%m%d"))
    assert (row["year"], row["month"], row["day"]) == (day.year, day.month, day.day)
    assert row["day_of_week"] == int(day.strftime("%w"))
    assert row["is_weekend"] == (day.isoweekday() > 5)


def test_landing_partition_is_zero_padded(spark):
    row = one(spark, **time.landing_partition(F.lit("2024-07-04 23:00:00").cast("timestamp")))
    assert tuple(row) == ("2024", "07", "04")


def test_numbers_survive_bad_input(spark):
    df = spark.createDataFrame([("12",), ("x",), ("1.5",), ("nan",), (None,), ("99999999999",)], "s string")
    got = df.select(numbers.int_or_null(F.col("s")), numbers.double_or_null(F.col("s"))).collect()
    assert [r[0] for r in got] == [12, None, None, None, None, None]
    assert [r[1] for r in got] == [12.0, None, 1.5, None, None, 99999999999.0]


def test_floats_truncate_toward_zero_and_nan_is_null(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (math.nan,), (1e300,)], "d double")
    assert [r[0] for r in df.select(numbers.int_or_null(F.col("d"))).collect()] == [2, -2, None, None]


def test_stored_hours_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (-0.125,), (None,)], "d double")
    got = [r[0] and str(r[0]) for r in df.select(numbers.stored_hours(F.col("d"))).collect()]
    assert got == ["1.01", "0.13", "-0.13", None]


def test_an_average_just_below_a_half_is_rounded_once(spark):
    hours = F.when(F.col("id") == 0, 1.04).otherwise(1.05).cast("decimal(10,2)")
    df = spark.range(100_000).select(hours.alias("h"))
    assert df.agg(numbers.rounded_average(F.col("h"))).first()[0] == 1.0
    assert df.where("h < 0").agg(numbers.rounded_average(F.col("h"))).first()[0] is None


def test_internal_flag_has_three_values(spark):
    df = spark.createDataFrame(
        [("EMAIL desk", None), (None, "re: End USER Digest"), ("Phone", "Pothole"), ("Phone", None), (None, None)],
        "source string, summary string",
    )
    got = [r[0] for r in df.select(flags.likely_internal(F.col("source"), F.col("summary"))).collect()]
    assert got == [True, True, False, None, None]


def test_box_includes_its_edges_and_excludes_missing_points(spark):
    points = [(39.5, -105.2), (40.0, -104.6), (40.01, -105.0), (0.0, 0.0), (None, -105.0), (39.7, None)]
    df = spark.createDataFrame(points, "lat double, lon double")
    got = [r[0] for r in df.select(flags.inside_box(F.col("lat"), F.col("lon"))).collect()]
    assert got == [True, True, False, False, False, False]
