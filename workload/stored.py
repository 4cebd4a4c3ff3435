"""Tables the queries need on disk (landed runs, clean batches, loaded warehouses).

Each is built once per Spark application and data folder by the jobs under test, below the
shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.operators.quality import QualityGateError
from civicflow.plans import end_to_end
from civicflow.plans.ingest import ingest
from civicflow.plans.load import load_star, read_star
from civicflow.plans.transform import stage_clean, transform
from civicflow.session import configure, scratch_dir, sized_shuffles
from civicflow.sources import landing
from civicflow.streaming import incremental
from workload import feed

FIRST_DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)
SECOND_DAY = datetime(2024, 1, 2, tzinfo=timezone.utc)
# More than half of a delivery's cases close before they open; that must not end a run here.
DIRTY = {"quarantine": True, "max_quarantined": 1.0}
RAW_COLUMNS = contracts.names(contracts.RAW_FEED)

_built: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]) -> object:
    """The result of ``build(path)``, computed on first use."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build(scratch_dir(spark, name))
    return _built[key]


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema after one load of the valid cases."""

    def build(path: str) -> str:
        load_batch(spark, feed.valid_requests(spark, sf_dir), path, "first", FIRST_DAY)
        return f"{path}/star"

    return read_star(spark, once(spark, sf_dir, "warehouse", build))


def two_loads(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a warehouse into which two overlapping deliveries were loaded in turn."""

    def build(path: str) -> str:
        for number, day in ((1, FIRST_DAY), (2, SECOND_DAY)):
            cases = feed.valid(feed.delivery(spark, sf_dir, number)).drop(*feed.EXTRA_COLUMNS)
            load_batch(spark, cases, path, f"delivery-{number}", day)
        return path

    return once(spark, sf_dir, "two_loads", build)


def warehouse_after_two(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return read_star(spark, f"{two_loads(spark, sf_dir)}/star")


def reloaded(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema after the same valid cases were loaded under two batch names."""

    def build(path: str) -> str:
        cases = feed.valid_requests(spark, sf_dir)
        for name in ("first", "again"):
            load_batch(spark, cases, path, name, FIRST_DAY)
        return f"{path}/star"

    return read_star(spark, once(spark, sf_dir, "reloaded", build))


def run_twice(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema after two whole runs (ingest, transform, load), one per delivery."""

    def build(path: str) -> str:
        for number, day in ((1, FIRST_DAY), (2, SECOND_DAY)):
            end_to_end.run(
                spark,
                feed.delivery(spark, sf_dir, number).select(*RAW_COLUMNS),
                path,
                run_id=f"run-{number}",
                run_at=day,
                full_refresh=True,
                incremental=True,
                transform_options=DIRTY,
            )
        return f"{path}/warehouse"

    return read_star(spark, once(spark, sf_dir, "run_twice", build))


def second_load(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Warehouse root and the batch of its second load."""
    path = two_loads(spark, sf_dir)
    return f"{path}/star", spark.read.parquet(f"{path}/batch-delivery-2")


def load_batch(spark: SparkSession, cases: DataFrame, path: str, name: str, day: datetime) -> None:
    batch = f"{path}/batch-{name}"
    with sized_shuffles(cases, feed.EXPANSION):
        cases.write.mode("overwrite").parquet(batch)
    load_star(spark, spark.read.parquet(batch), f"{path}/star", batch_id=name, loaded_at=day)


def land(rows: DataFrame, path: str) -> None:
    """A run's files alone, as a stream picks them up."""
    with sized_shuffles(rows, feed.EXPANSION):
        landing.write_landing(rows, path)


def landed(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """Root and manifest of one run that landed every raw row."""

    def build(path: str) -> tuple[str, dict]:
        source = feed.raw_requests(spark, sf_dir).select(*RAW_COLUMNS)
        manifest = ingest(
            spark,
            source,
            path,
            run_id="run-1",
            run_at=FIRST_DAY,
            full_refresh=True,
            rows_per_file=100_000,
        )
        return path, manifest

    return once(spark, sf_dir, "landed", build)


def landed_with_short_run(spark: SparkSession, sf_dir: str) -> str:
    """Root with a complete first delivery and a second one that came up short."""

    def build(path: str) -> str:
        for number, day, announced in ((1, FIRST_DAY, None), (2, SECOND_DAY, 10**12)):
            source = feed.delivery(spark, sf_dir, number).select(*RAW_COLUMNS)
            ingest(
                spark,
                source,
                path,
                run_id=f"run-{number}",
                run_at=day,
                full_refresh=True,
                expected=announced,
                sort_key="OBJECTID",
            )
        return path

    return once(spark, sf_dir, "landed_with_short_run", build)


def transformed(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """Published clean cases of the landed run, and the run's summary."""

    def build(path: str) -> tuple[str, dict]:
        root, _ = landed(spark, sf_dir)
        return path, transform(spark, root, path, batch_id="run-1", **DIRTY)

    return once(spark, sf_dir, "transformed", build)


def streamed_root(spark: SparkSession, sf_dir: str) -> str:
    """Warehouse of a stream that picked up two deliveries, each as it landed, and keeps one version."""

    def build(path: str) -> str:
        for number, day in ((1, FIRST_DAY), (2, SECOND_DAY)):
            source = feed.delivery(spark, sf_dir, number).select(*RAW_COLUMNS)
            land(source, f"{path}/raw/{landing.run_directory(f'run-{number}', day)}")
            options = DIRTY | {"keep_versions": 1}
            query = incremental.start(spark, f"{path}/raw", f"{path}/star", f"{path}/work", **options)
            query.awaitTermination()
        return f"{path}/star"

    return once(spark, sf_dir, "streamed", build)


def streamed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return read_star(spark, streamed_root(spark, sf_dir))


def parked(spark: SparkSession, sf_dir: str) -> str:
    """Root after three incremental runs: one whose rows always fail the gate, and the valid cases
    of both deliveries."""

    def build(path: str) -> str:
        valid = [feed.valid(feed.delivery(spark, sf_dir, number)) for number in (1, 2)]
        sources = [(feed.delivery(spark, sf_dir, 1), FIRST_DAY), (valid[0], FIRST_DAY), (valid[1], SECOND_DAY)]
        for number, (source, day) in enumerate(sources, 1):
            end_to_end.run(
                spark, source.select(*RAW_COLUMNS), path, run_id=f"run-{number}", run_at=day, full_refresh=True,
                incremental=True, park_failures=True,
            )
        return path

    return once(spark, sf_dir, "parked", build)


def recovered(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema after a run whose gate failed and one that succeeded, both incremental."""

    def build(path: str) -> str:
        first = feed.delivery(spark, sf_dir, 1).select(*RAW_COLUMNS)
        second = feed.delivery(spark, sf_dir, 2).select(*RAW_COLUMNS)
        options = {"full_refresh": True, "incremental": True}
        try:
            end_to_end.run(spark, first, path, run_id="run-1", run_at=FIRST_DAY, **options)
        except QualityGateError:
            kind = {"transform_options": DIRTY}
            end_to_end.run(spark, second, path, run_id="run-2", run_at=SECOND_DAY, **options, **kind)
        return f"{path}/warehouse"

    return read_star(spark, once(spark, sf_dir, "recovered", build))


def restarted(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema after a stream took the first delivery, and one with a new work folder
    took all that had landed by then."""

    def build(path: str) -> str:
        for number, day in ((1, FIRST_DAY), (2, SECOND_DAY)):
            source = feed.delivery(spark, sf_dir, number).select(*RAW_COLUMNS)
            land(source, f"{path}/raw/{landing.run_directory(f'run-{number}', day)}")
            work = f"{path}/work-{number}"
            incremental.start(spark, f"{path}/raw", f"{path}/star", work, **DIRTY).awaitTermination()
        return f"{path}/star"

    return read_star(spark, once(spark, sf_dir, "restarted", build))


def idle_run(spark: SparkSession, sf_dir: str) -> str:
    """Root of a run over the first delivery, then one whose source has nothing new."""

    def build(path: str) -> str:
        source = feed.delivery(spark, sf_dir, 1).select(*RAW_COLUMNS)
        for number, day, rows in ((1, FIRST_DAY, source), (2, SECOND_DAY, source.where("false"))):
            end_to_end.run(
                spark, rows, path, run_id=f"run-{number}", run_at=day, full_refresh=True, incremental=True,
                transform_options=DIRTY,
            )
        return path

    return once(spark, sf_dir, "idle_run", build)


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows of a delivery in which the lines of every 50th case are cut off."""

    def build(path: str) -> DataFrame:
        raw = feed.raw_requests(spark, sf_dir).select(*RAW_COLUMNS)
        line = F.to_json(F.struct(*RAW_COLUMNS))
        line = F.when(F.col("OBJECTID") % 50 == 0, F.substring(line, 1, 20)).otherwise(line)
        raw.select(line.alias("value")).write.option("compression", "gzip").text(f"{path}/lines")
        columns = [*contracts.RAW_FEED, (contracts.CORRUPT_COLUMN, "string")]
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": contracts.CORRUPT_COLUMN}
        parsed = F.from_json("value", contracts.ddl(columns), options).alias("r")
        levels = dict(zip(contracts.names(contracts.LANDING_PARTITIONS), ("2024", "01", "01", "run-1")))
        lines = spark.read.text(f"{path}/lines").select(parsed, landing.scan_position().alias(landing.ROW_ID))
        rows = lines.select("r.*", *(F.lit(v).alias(k) for k, v in levels.items()), landing.ROW_ID)
        return stage_clean(rows, f"{path}/staged", landing.ROW_ID)

    return once(spark, sf_dir, "damaged", build)


def named_facts(star: dict[str, DataFrame]) -> DataFrame:
    """Facts with their dimension members' names instead of keys, and times as numbers."""
    fact = star["fact_service_request"]
    return (
        fact.join(star["dim_agency"], "agency_key", "left")
        .join(star["dim_service_type"], "service_type_key", "left")
        .join(star["dim_neighborhood"], "neighborhood_key", "left")
        .select(
            "object_id",
            "agency_name",
            "type_name",
            "topic_name",
            "neighborhood_name",
            "created_date_key",
            F.unix_millis("created_at").alias("created_ms"),
            F.unix_millis("closed_at").alias("closed_ms"),
            "case_status",
            "case_source",
            "is_closed",
            F.col("resolution_hours").cast("double").alias("resolution_hours"),
            "is_likely_internal",
            "has_valid_coordinates",
            "latitude",
            "longitude",
            "incident_address",
            F.unix_millis("loaded_at").alias("loaded_ms"),
        )
    )
