"""Time the headline jobs and queries; prints one JSON line.

Everything runs twice and the second time counts: jobs write fresh tables each time, queries
go to a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from civicflow.plans.ingest import ingest
from civicflow.plans.load import load_star
from civicflow.plans.transform import read_clean, transform
from civicflow.session import configure, scratch_dir
from workload import feed, spark_queries, stored

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

QUERIES = [
    "agency_report_from_raw",
    "dedup_latest",
    "dedup_dirty",
    "clean_requests",
    "transform_summary",
    "quality_report",
    "quality_report_dirty",
    "preview_latest",
    "dim_neighborhood_lazy",
    "load_counts",
    "total_requests",
    "requests_by_agency",
    "requests_by_day",
    "requests_by_neighborhood",
    "resolution_population",
    "resolution_stats",
    "resolution_histogram",
    "map_points",
    "resolution_by_year",
    "incremental_extract",
    "changed_extract",
    "past_slice_marks",
    "landing_roundtrip",
    "key_discontinuity",
]


def run_jobs(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Land, transform, load, merge a second delivery; seconds per job."""
    root = scratch_dir(spark, "bench")
    times = {}

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    source = feed.raw_requests(spark, sf_dir).select(*stored.RAW_COLUMNS)
    first, second = stored.FIRST_DAY, stored.SECOND_DAY
    options = {"run_id": "run-1", "run_at": first, "full_refresh": True, "rows_per_file": 100_000}
    timed("job_ingest", lambda: ingest(spark, source, f"{root}/raw", **options))
    timed(
        "job_transform",
        lambda: transform(spark, f"{root}/raw", f"{root}/out", batch_id="run-1", **stored.DIRTY),
    )
    clean = read_clean(spark, f"{root}/out")
    timed("job_load", lambda: load_star(spark, clean, f"{root}/star", batch_id="a", loaded_at=first))
    timed("job_merge", lambda: load_star(spark, clean, f"{root}/star", batch_id="b", loaded_at=second))
    month = clean.where("created_at >= '1997-03-01' and created_at < '1997-04-01'")
    timed("job_merge_month", lambda: load_star(spark, month, f"{root}/star", batch_id="c", loaded_at=second))
    return times


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("civicflow-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)

    run_jobs(spark, SF_DIR)
    times = run_jobs(spark, SF_DIR)
    registered = spark_queries.registered()
    for name in QUERIES:
        for _ in range(2):
            start = time.perf_counter()
            discard(registered[name](spark, SF_DIR))
            times[name] = round(time.perf_counter() - start, 3)

    line = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
