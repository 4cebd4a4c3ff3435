from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civicflow import contracts  # noqa: E402
from civicflow.session import configure  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

# One tidy, open, public case; a test states only what it changes.
CASE = {
    "OBJECTID": 7,
    "Case_Summary": "Fallen tree",
    "Case_Status": "Open",
    "Case_Source": "Phone",
    "Case_Created_Date": 1_710_000_000_000,
    "Case_Created_dttm": "3/9/2024 4:00:00 PM",
    "Case_Closed_Date": None,
    "Case_Closed_dttm": None,
    "First_Call_Resolution": "N",
    "Customer_Zip_Code": "80210",
    "Incident_Address_1": "12 Elm Ave",
    "Incident_Address_2": None,
    "Incident_Intersection_1": None,
    "Incident_Intersection_2": None,
    "Incident_Zip_Code": "80210",
    "Longitude": -104.9,
    "Latitude": 39.7,
    "Agency": "Parks",
    "Division": "Forestry",
    "Major_Area": "Outdoors",
    "Type": "Tree",
    "Topic": "Hazard",
    "Council_District": 3,
    "Police_District": 2,
    "Neighborhood": "Hilltop",
}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("civicflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def cases(spark):
    """Raw rows from the changes to ``CASE``; extra columns may be declared as DDL."""

    def build(*changes: dict, extra: str = ""):
        schema = contracts.ddl(contracts.RAW_FEED) + (f", {extra}" if extra else "")
        columns = [part.split(" ")[0] for part in extra.split(", ")] if extra else []
        names = [*contracts.names(contracts.RAW_FEED), *columns]
        rows = [tuple({**CASE, **change}.get(n) for n in names) for change in changes]
        return spark.createDataFrame(rows, schema)

    return build


def executed_plan(df) -> str:
    """The plan after running, subqueries included, without the plans AQE started from."""
    df.collect()
    kept, initial = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-|"))
        if initial is not None and depth >= initial:
            continue
        initial = depth if "== Initial Plan ==" in line else None
        if initial is None:
            kept.append(line)
    return "\n".join(kept)
