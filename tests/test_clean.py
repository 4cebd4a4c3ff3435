from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.operators import clean, dedup

LANDED = "ingest_year string, ingest_month string, ingest_day string, run_id string"


def test_one_row_per_key_is_kept(cases):
    df = cases({"OBJECTID": 1}, {"OBJECTID": 1}, {"OBJECTID": 2})
    assert sorted(r["OBJECTID"] for r in dedup.keep_latest(df).collect()) == [1, 2]


def test_the_latest_created_row_wins_and_missing_dates_lose(cases):
    df = cases(
        {"OBJECTID": 1, "Case_Created_Date": 50, "Case_Status": "old"},
        {"OBJECTID": 1, "Case_Created_Date": 90, "Case_Status": "new"},
        {"OBJECTID": 1, "Case_Created_Date": None, "Case_Status": "undated"},
    )
    assert [r["Case_Status"] for r in dedup.keep_latest(df).collect()] == ["new"]


def test_equal_creation_times_go_to_the_later_delivery(cases):
    first = {"ingest_year": "2024", "ingest_month": "01", "ingest_day": "31", "run_id": "a"}
    later = {**first, "ingest_month": "02", "ingest_day": "01"}
    df = cases({"Case_Status": "before", **first}, {"Case_Status": "after", **later}, extra=LANDED)
    assert [r["Case_Status"] for r in dedup.keep_latest(df).collect()] == ["after"]


def test_ties_are_broken_the_same_way_whatever_the_row_order(cases):
    rows = [{"Case_Status": s, "Agency": a} for s in "abc" for a in "xyz"]
    picks = {
        dedup.keep_latest(cases(*order)).first()["Case_Status"]
        for order in (rows, rows[::-1], rows[4:] + rows[:4])
    }
    assert picks == {"c"}


@pytest.mark.parametrize("numbered", [False, True])
def test_rows_without_a_key_all_stay(cases, numbered):
    df = cases({"OBJECTID": None}, {"OBJECTID": None}, {"OBJECTID": 1}, {"OBJECTID": 1})
    row_id = None
    if numbered:
        df, row_id = df.withColumn("n", F.monotonically_increasing_id()), "n"
    kept = dedup.keep_latest(df, row_id=row_id)
    assert sorted((r["OBJECTID"] or 0) for r in kept.collect()) == [0, 0, 1]


def test_missing_keys_can_count_as_one_key(cases):
    df = cases({"OBJECTID": None}, {"OBJECTID": None}, {"OBJECTID": 1})
    assert dedup.keep_latest(df, null_keys="collapse").count() == 2


def test_an_unknown_null_key_mode_is_refused(cases):
    with pytest.raises(ValueError, match="null_keys"):
        dedup.keep_latest(cases({}), null_keys="drop")


def test_listed_text_is_tidied_and_other_text_left_alone(cases):
    df = cases({"Neighborhood": "   ", "Type": "", "Agency": "  Parks ", "First_Call_Resolution": " Y "})
    row = clean.tidy_text(df).first()
    assert (row["Neighborhood"], row["Type"], row["Agency"]) == (None, None, "Parks")
    assert row["First_Call_Resolution"] == " Y "


def test_open_and_closed_cases(cases):
    start = 1_710_000_000_000
    df = cases({"OBJECTID": 1}, {"OBJECTID": 2, "Case_Closed_Date": start + 5_400_000})
    rows = {r["OBJECTID"]: r for r in clean.clean_requests(df).collect()}
    assert (rows[1]["is_closed"], rows[1]["resolution_hours"]) == (False, None)
    assert (rows[2]["is_closed"], rows[2]["resolution_hours"]) == (True, 1.5)


def test_flags_see_the_tidied_text(cases):
    df = cases({"OBJECTID": 1, "Case_Source": "  Email - Desk"}, {"OBJECTID": 2, "Case_Source": "  "})
    rows = {r["OBJECTID"]: r for r in clean.clean_requests(df).collect()}
    assert rows[1]["is_likely_internal"] is True
    assert rows[2]["is_likely_internal"] is None


def test_clean_rows_have_the_contracted_columns(cases):
    expected = [*contracts.RAW_FEED, *contracts.DERIVED_FIELDS]
    assert clean.clean_requests(cases({})).dtypes == expected


def test_cleaning_clean_rows_changes_nothing(cases):
    df = cases({"OBJECTID": 1, "Agency": " P "}, {"OBJECTID": 1}, {"OBJECTID": 2, "Latitude": 0.0})
    once = clean.clean_requests(df)
    again = clean.clean_requests(once.select(*contracts.names(contracts.RAW_FEED)))
    assert sorted(once.collect()) == sorted(again.collect())


def test_probable_copies_need_all_three_parts(cases):
    df = clean.clean_requests(
        cases(
            {"OBJECTID": 1},
            {"OBJECTID": 2},
            {"OBJECTID": 3, "Type": None},
            {"OBJECTID": 4, "Type": None},
            {"OBJECTID": 5, "Incident_Address_1": "elsewhere"},
        )
    )
    kept = sorted(r["OBJECTID"] for r in dedup.drop_probable_copies(df).collect())
    assert kept == [2, 3, 4, 5]
