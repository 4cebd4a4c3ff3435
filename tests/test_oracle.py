"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import math

import __spark_entry__ as entry
import duckdb
import pytest
from conftest import SF_DIR

from workload import oracle, spark_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES, ORACLE = spark_queries.registered(), oracle.oracle()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(rows, names):
    """Rows with columns in name order; floats to twelve digits; sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.12g}"
        return repr(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got, expected = comparable(df.collect(), df.columns), comparable(result.fetchall(), columns)
    assert len(got) > 0
    assert got == expected


def test_the_entry_query_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["agency_name", "total_requests", "closed_requests", "avg_resolution_hours"]
    assert df.count() > 0
