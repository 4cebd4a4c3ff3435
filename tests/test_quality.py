from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.operators import quality

SCHEMA = (
    "OBJECTID bigint, created_at timestamp, closed_at timestamp, is_closed boolean, resolution_hours double, "
    "is_likely_internal boolean, has_valid_coordinates boolean, Latitude double"
)
GOOD = {
    "OBJECTID": 1,
    "created_at": datetime(2024, 3, 1),
    "closed_at": datetime(2024, 3, 4),
    "is_closed": True,
    "resolution_hours": 72.0,
    "is_likely_internal": False,
    "has_valid_coordinates": True,
    "Latitude": 39.7,
}


@pytest.fixture
def batch(spark):
    def build(*changes):
        return spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in changes], SCHEMA)

    return build


def numbered(count, change=lambda i: {}):
    return [{"OBJECTID": i, **change(i)} for i in range(count)]


def failed(df) -> dict[str, str]:
    return {r["check_name"]: r["severity"] for r in quality.quality_report(df).where("failed").collect()}


def test_a_good_batch_passes(batch):
    result = quality.run_gate(batch(*numbered(3)))
    assert (result.passed, result.row_count, result.warnings) == (True, 3, [])


def test_missing_columns_are_reported_alone(spark):
    df = spark.createDataFrame([(1,)], "OBJECTID bigint")
    result = quality.gate_result(quality.quality_report(df))
    assert result.row_count == 1
    assert len(result.hard_failures) == 1
    assert "Missing required columns" in result.hard_failures[0]
    with pytest.raises(quality.QualityGateError):
        quality.run_gate(df)


@pytest.mark.parametrize("column", contracts.REQUIRED_BY_GATE)
def test_every_required_column_is_required(batch, column):
    assert failed(batch({}).drop(column)) == {"required_columns": "hard"}


@pytest.mark.parametrize(
    "changes, check",
    [
        ([{"OBJECTID": None}], "key_not_null"),
        ([{"OBJECTID": 4}, {"OBJECTID": 4}], "key_unique"),
        ([{"created_at": None}], "created_at_not_null"),
        ([{"closed_at": datetime(2024, 2, 1)}], "closed_before_created"),
    ],
)
def test_hard_checks_stop_the_batch(batch, changes, check):
    df = batch(*numbered(3, lambda i: {"OBJECTID": i + 10}), *changes)
    assert failed(df) == {check: "hard"}
    with pytest.raises(quality.QualityGateError, match="1 hard check"):
        quality.run_gate(df)


def test_several_rows_without_key_are_counted_and_repeat_the_null_key(batch):
    rows = {r["check_name"]: r["value"] for r in quality.quality_report(batch(*[{"OBJECTID": None}] * 3)).collect()}
    assert rows["key_not_null"] == 3
    assert rows["key_unique"] == 2


def test_an_open_case_is_not_out_of_order(batch):
    assert failed(batch({"closed_at": None, "is_closed": False})) == {}


@pytest.mark.parametrize("internal, warns", [(4, False), (5, True)])
def test_internal_rate_warns_only_above_its_limit(batch, internal, warns):
    df = batch(*numbered(10, lambda i: {"is_likely_internal": i < internal}))
    result = quality.run_gate(df)
    assert bool(result.warnings) == warns


def test_unknown_internal_flags_count_as_rows(batch):
    df = batch(*numbered(10, lambda i: {"is_likely_internal": True if i < 4 else None}))
    assert quality.run_gate(df).warnings == []


@pytest.mark.parametrize("valid, warns", [(9, False), (8, True)])
def test_coordinate_rate_warns_only_below_its_limit(batch, valid, warns):
    df = batch(*numbered(10, lambda i: {"has_valid_coordinates": i < valid}))
    assert bool(quality.run_gate(df).warnings) == warns


def test_rows_without_latitude_are_outside_the_coordinate_rate(batch):
    df = batch(*numbered(5, lambda i: {"Latitude": None, "has_valid_coordinates": False}))
    assert quality.run_gate(df).warnings == []


def test_an_empty_batch_passes_without_warnings(batch):
    result = quality.run_gate(batch({}).where("false"))
    assert (result.passed, result.row_count, result.warnings) == (True, 0, [])


def test_a_user_check_joins_the_same_report(batch):
    check = quality.Check(
        "hours_limit",
        quality.HARD,
        F.max("resolution_hours"),
        lambda v: v > 48,
        lambda v: F.format_string("longest case took %.0f hours", v),
        48.0,
    )
    with pytest.raises(quality.QualityGateError, match="took 72 hours"):
        quality.run_gate(batch({}), [*quality.default_checks(), check])


def test_the_gate_reads_its_input_once(batch, tmp_path):
    batch(*numbered(5)).write.parquet(str(tmp_path / "t"))
    stored = batch({}).sparkSession.read.parquet(str(tmp_path / "t"))
    plan = quality.quality_report(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_single_pass_equals_separate_counts(batch):
    df = batch(
        *numbered(8, lambda i: {"created_at": None if i % 3 == 0 else GOOD["created_at"]}),
        {"OBJECTID": 2},
        {"OBJECTID": None, "closed_at": datetime(2020, 1, 1)},
    )
    values = {r["check_name"]: r["value"] for r in quality.quality_report(df).collect()}
    assert values["key_not_null"] == df.where("OBJECTID is null").count()
    assert values["key_unique"] == df.count() - df.select("OBJECTID").distinct().count()
    assert values["created_at_not_null"] == df.where("created_at is null").count()
    assert values["closed_before_created"] == df.where("closed_at < created_at").count()


def test_quarantine_splits_rows_and_names_their_problems(batch):
    df = batch({"OBJECTID": 1}, {"OBJECTID": None, "created_at": None}, {"OBJECTID": 2, "closed_at": datetime(2020, 1, 1)})
    good, bad = quality.split_quarantine(df)
    assert [r["OBJECTID"] for r in good.collect()] == [1]
    problems = sorted(r["problems"] for r in bad.collect())
    assert problems == [["closed_before_created"], ["key_not_null", "created_at_not_null"]]


def test_contract_differences(spark):
    df = spark.createDataFrame([(1, "x", True)], "a int, b string, c boolean")
    rows = quality.contract_diff(df, [("a", "bigint"), ("b", "string"), ("d", "double")]).collect()
    found = {r["name"]: (r["change"], r["declared_type"], r["actual_type"]) for r in rows}
    assert found == {
        "a": ("retyped", "bigint", "int"),
        "c": ("added", None, "boolean"),
        "d": ("missing", "double", None),
    }


def test_contract_profile_counts_values_and_notes_missing_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = quality.contract_profile(df, [("a", "bigint"), ("b", "string"), ("d", "double")]).collect()
    found = {r["name"]: (r["matches"], r["filled"], r["total"]) for r in rows}
    assert found == {"a": (False, 2, 2), "b": (True, 1, 2), "d": (False, 0, 2)}
