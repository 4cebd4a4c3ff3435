"""Physical plans: what must hold when the data is a thousand times larger."""

from __future__ import annotations

import contextlib
import inspect
import re

import pytest
from conftest import SF_DIR, executed_plan
from pyspark.sql import functions as F

from civicflow import session
from civicflow.operators import dedup, distribution, key_sketch, metrics
from civicflow.plans import ingest, load
from civicflow.sources import landing, tables
from workload import feed, spark_queries, stored


@contextlib.contextmanager
def conf(spark, **settings):
    """Session settings for a block; double underscores stand for dots."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Make AQE treat small partitions as it would treat large ones.
SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "2k",
    "spark__sql__adaptive__coalescePartitions__minPartitionSize": "1k",
    "spark__sql__shuffle__partitions": "16",
}


def limits_around_exchange(plan: str) -> bool:
    """Whether rows pass a rank limit before the last exchange below the window."""
    below = plan[plan.index("Window [") :]
    partial = below.find("row_number(), 1, Partial")
    exchange = below.find("Exchange hashpartitioning(_w")
    return -1 < exchange < partial


def test_rank_limit_runs_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 9).alias("k"), "id").write.parquet(path)
    plan = executed_plan(dedup.keep_latest(spark.read.parquet(path), ["k"], [F.desc("id")]))
    assert limits_around_exchange(plan)
    assert plan.count("FileScan") == 2  # rows with a key, and the pruned branch for those without
    assert "PushedFilters: [IsNull(k)]" in plan


def test_numbered_rows_are_scanned_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select((F.col("id") % 9).alias("k"), "id").write.parquet(path)
    df = spark.read.parquet(path).withColumn("n", F.monotonically_increasing_id())
    plan = executed_plan(dedup.keep_latest(df, ["k"], [F.desc("id")], row_id="n"))
    assert plan.count("FileScan") == 1
    assert limits_around_exchange(plan)


def test_a_key_with_a_third_of_the_rows(spark, tmp_path):
    """Its join partition is split, and the split tasks pass on one row each."""
    left, right = str(tmp_path / "l"), str(tmp_path / "r")
    spread = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    spread.repartition(16).write.parquet(left)
    spark.range(60_000).select(F.col("id").alias("key"), F.lit("x").alias("name")).write.parquet(right)
    with conf(spark, **SMALL):
        joined = spark.read.parquet(left).join(spark.read.parquet(right), F.col("k") == F.col("key"))
        kept = dedup.keep_latest(joined, ["k"], [F.desc("v")], null_keys="collapse")
        plan = executed_plan(kept)
        top = {r["k"]: r["v"] for r in kept.where("k < 4").collect()}
    assert "skew=true" in plan
    assert limits_around_exchange(plan)
    assert top == {1: 59_997, 2: 2}


def test_shuffles_start_with_partitions_for_the_input(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(50_000).write.parquet(path)
    df = spark.read.parquet(path)
    assert session.partitions_for(df) == 4
    monkeypatch.setattr(session, "PARTITION_BYTES", 1024)
    wanted = session.partitions_for(df)
    assert wanted > 100
    assert session.partitions_for(df.join(df.withColumnRenamed("id", "other"), F.col("id") == F.col("other"))) < 3 * wanted
    assert session.partitions_for(spark.createDataFrame([(1,)], "id bigint")) == 4
    counted = df.groupBy("id").count()
    with session.sized_shuffles(df):
        inside = counted._jdf.queryExecution().executedPlan().toString()
    outside = df.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning(id#{_number(inside)}, {wanted})" in inside
    assert f"hashpartitioning(id#{_number(outside)}, 4)" in outside


def _number(plan: str) -> str:
    return re.search(r"hashpartitioning\(id#(\w+),", plan).group(1)


def test_feed_rows_are_shuffled_once_for_the_join(spark):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = executed_plan(feed.raw_requests(spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


def test_reports_read_only_their_columns(spark):
    plan = executed_plan(spark_queries.total_requests(spark, SF_DIR))
    assert "ReadSchema: struct<is_likely_internal:boolean>" in plan
    plan = executed_plan(spark_queries.requests_by_day(spark, SF_DIR))
    assert "ReadSchema: struct<created_date_key:int,is_likely_internal:boolean>" in plan


@pytest.mark.parametrize("report", ["requests_by_agency", "requests_by_neighborhood", "resolution_by_year"])
def test_facts_are_grouped_by_key_before_the_dimension_join(spark, report):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = executed_plan(getattr(spark_queries, report)(spark, SF_DIR))
    join = plan.index("SortMergeJoin")
    assert "partial_count(1)" in plan[join:]
    assert "partial_count(1)" not in plan[:join]


def test_statistics_scan_the_facts_once(spark):
    hours = metrics.resolution_hours(stored.warehouse(spark, SF_DIR)["fact_service_request"])
    for df in (
        distribution.resolution_stats(hours),
        distribution.histogram(distribution.value_counts(hours)),
    ):
        assert executed_plan(df).count("FileScan") == 1


def test_probable_copies_and_headline_scan_once_each(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(60).selectExpr("id as OBJECTID", "if(id % 5 = 0, null, id % 7) as a", "id % 3 as b").write.parquet(path)
    kept = dedup.drop_probable_copies(spark.read.parquet(path), ["a", "b"], row_key="OBJECTID")
    plan = executed_plan(kept)
    assert plan.count("FileScan") == 1 and limits_around_exchange(plan)
    assert kept.where("a is null").count() == 12 and kept.where("a is not null").count() == 21
    plan = executed_plan(spark_queries.headline_figures(spark, SF_DIR))
    assert plan.count("fact_service_request") <= plan.count("FileScan") == 3  # facts twice, agencies once


def test_previews_and_map_points_are_top_k(spark):
    for query in (spark_queries.map_points, spark_queries.preview_latest):
        assert "TakeOrderedAndProject" in executed_plan(query(spark, SF_DIR))


def test_no_query_needs_a_cross_join_or_python_rows(spark):
    for name, query in spark_queries.registered().items():
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
            assert operator not in plan, (name, operator)


def test_compressed_files_are_packed_by_what_they_expand_to(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "lines")
    spark.range(8_000).repartition(8).write.option("compression", "gzip").json(path)
    size = tables.stored_bytes(spark, path) // 8
    monkeypatch.setattr(session, "PARTITION_BYTES", 20 * size)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(key) for key in keys]
    with conf(spark, spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1"):
        lines = spark.read.schema("id bigint").json(path)
        assert spark.read.schema("id bigint").json(path).rdd.getNumPartitions() == 1
        with session.sized_shuffles(lines, 10.0):
            inside = spark.read.schema("id bigint").json(path)
            assert inside.rdd.getNumPartitions() >= 4
            assert [int(spark.conf.get(key)) for key in keys] == [2 * size] * 2
    assert [spark.conf.get(key) for key in keys] == before


def test_sketch_positions_are_made_behind_the_exchange(spark, monkeypatch):
    """No task sorts the positions of a whole part's keys: keys are exchanged, and once."""
    monkeypatch.setattr(key_sketch, "KEYS_PER_TASK", 100)
    keys = spark.range(1000).select((F.col("id") % 2).cast("string").alias("part"), F.col("id").alias("key"))
    sketch = key_sketch.sketches(keys, 4, 1000)
    assert sketch.rdd.getNumPartitions() == 10
    plan = executed_plan(sketch)
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")


def test_a_part_of_the_fact_fits_the_task_that_sorts_it():
    size = inspect.signature(load.load_star).parameters["part_bytes"].default
    assert size * load.EXPANSION <= 2 * session.PARTITION_BYTES


def test_feed_tables_are_built_in_tasks_by_their_size(spark, tmp_path, monkeypatch):
    used = {}

    def record(name):
        return lambda *rows, **options: used.update({name: session.shuffle_partitions(spark)})

    monkeypatch.setattr(landing, "write_landing", record("landing"))
    monkeypatch.setattr(feed, "EXPANSION", 10_000.0)
    rows = feed.raw_requests(spark, SF_DIR)
    stored.land(rows, str(tmp_path / "raw"))
    assert used["landing"] == session.partitions_for(rows, 10_000.0) > 4
    assert session.shuffle_partitions(spark) == 4


def test_a_source_is_landed_in_tasks_by_its_size(spark, tmp_path, monkeypatch):
    used, plain = [], landing.write_landing
    monkeypatch.setattr(landing, "write_landing", lambda *a: used.append(session.shuffle_partitions(spark)) or plain(*a))
    monkeypatch.setattr(ingest, "EXPANSION", 10_000.0)
    source = feed.raw_requests(spark, SF_DIR).select(*stored.RAW_COLUMNS)
    ingest.ingest(spark, source, str(tmp_path), run_id="r", run_at=stored.FIRST_DAY, full_refresh=True)
    assert used[0] > 4
