"""One function per registered query: (session, data folder) to DataFrame.

Instants are returned as epoch milliseconds and calendar days as ISO text, so results compare
independently of how a client renders them.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.functions import flags, numbers, text, time
from civicflow.operators import (
    clean,
    dedup,
    dimensions,
    distribution,
    drift,
    facts,
    metrics,
    quality,
    summaries,
)
from civicflow.plans import dashboard, holding, load
from civicflow.plans.ingest import ingest
from civicflow.plans.transform import quarantined_rows, rate_checks, read_clean
from civicflow.session import scratch_dir
from civicflow.sources import extract, landing, snapshots, tables
from workload import feed, stored

UTC = timezone.utc
ORDERS_MARK = datetime(1998, 6, 1, tzinfo=UTC)
EVENTS_MARK = datetime(2024, 1, 15, 12, 30, 15, 900_000, tzinfo=UTC)
EVENTS_NOW = datetime(2024, 2, 10, tzinfo=UTC)


def as_numbers(df: DataFrame) -> DataFrame:
    """Clean cases with their two instants as epoch milliseconds."""
    return df.withColumns(
        {"created_at": F.unix_millis("created_at"), "closed_at": F.unix_millis("closed_at")}
    ).withColumnsRenamed({"created_at": "created_ms", "closed_at": "closed_ms"})


def day_as_text(df: DataFrame, column: str = "full_date") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


# --- cleaning ----------------------------------------------------------------------


def agency_report_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows to the headline report in one plan, without stored tables."""
    cases = clean.derive_fields(
        clean.parse_dates(clean.tidy_text(feed.deduped(feed.raw_requests(spark, sf_dir))))
    )
    on_time = ~flags.closed_too_early(F.col("created_at"), F.col("closed_at"))
    public = cases.where(on_time & ~numbers.false_if_null(F.col("is_likely_internal")))
    return (
        public.where(text.is_present(F.col("Agency")))
        .groupBy(F.col("Agency").alias("agency_name"))
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.count_if(F.col("is_closed")).alias("closed_requests"),
            numbers.rounded_average(numbers.stored_hours(F.col("resolution_hours"))).alias(
                "avg_resolution_hours"
            ),
        )
        .orderBy(F.desc("total_requests"), "agency_name")
    )


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.deduped(feed.raw_requests(spark, sf_dir))


def dedup_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key all stay, the others are reduced to the newest per key."""
    kept = feed.deduped(feed.dirty_requests(spark, sf_dir), null_keys="keep")
    return kept.select("OBJECTID", "Case_Created_Date", *feed.EXTRA_COLUMNS)


def dedup_null_as_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = feed.deduped(feed.dirty_requests(spark, sf_dir), null_keys="collapse")
    return kept.select("OBJECTID", "Case_Created_Date", *feed.EXTRA_COLUMNS)


def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feed.raw_requests(spark, sf_dir)
    return clean.tidy_text(raw).select(
        "OBJECTID", "part_no", *contracts.TRIMMED_COLUMNS, "First_Call_Resolution", "Incident_Intersection_1"
    )


def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events")
    ms = time.to_epoch_ms(F.col("ts"))
    back = time.from_epoch_ms(ms)
    return events.select(
        "event_id",
        ms.alias("epoch_ms"),
        time.to_epoch_seconds(F.col("ts")).alias("epoch_s"),
        time.to_epoch_ms(back).alias("back_ms"),
        time.hours_between(F.lit("2024-01-01").cast("timestamp"), F.col("ts")).alias("hours"),
    )


def derive_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = feed.clean(feed.raw_requests(spark, sf_dir))
    return as_numbers(cases).select(
        "OBJECTID",
        "created_ms",
        "closed_ms",
        "is_closed",
        "resolution_hours",
        "is_likely_internal",
        "has_valid_coordinates",
    )


def clean_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_numbers(feed.clean(feed.raw_requests(spark, sf_dir)).drop(*feed.EXTRA_COLUMNS))


def probable_copies_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup.drop_probable_copies(feed.valid_requests(spark, sf_dir), row_key="OBJECTID")
    return as_numbers(kept).select("OBJECTID", "created_ms", "Incident_Address_1", "Type")


def transform_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feed.raw_requests(spark, sf_dir)
    return summaries.transform_summary(raw, feed.clean(raw))


def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.duplicate_count(feed.dirty_requests(spark, sf_dir))


def preview_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = feed.valid_requests(spark, sf_dir)
    return as_numbers(summaries.latest_rows(cases, contracts.PREVIEW_COLUMNS, contracts.PREVIEW_ROWS))


# --- quality -----------------------------------------------------------------------


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(feed.clean(feed.raw_requests(spark, sf_dir)))


def quality_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(feed.clean(feed.dirty_requests(spark, sf_dir), null_keys="keep"))


def quality_report_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over every delivered copy, as if deduplication had not run."""
    raw = feed.raw_requests(spark, sf_dir)
    return quality.quality_report(raw.transform(clean.tidy_text).transform(clean.parse_dates).transform(
        clean.derive_fields
    ))


def quality_report_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery without two of the columns that the gate needs."""
    cases = feed.clean(feed.raw_requests(spark, sf_dir))
    return quality.quality_report(cases.drop("closed_at", "Latitude"))


def damaged_lines_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of damaged lines and of rows set apart, over all staged rows."""
    checks = rate_checks(contracts.MAX_CORRUPT_RATE, 0.1)
    report = quality.quality_report(stored.damaged(spark, sf_dir), checks)
    return report.select("check_name", "severity", F.round("value", 9).alias("value"), "threshold", "failed")


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = quality.split_quarantine(
        feed.clean(feed.dirty_requests(spark, sf_dir), null_keys="keep")
    )
    return bad.select(F.explode("problems").alias("problem")).groupBy("problem").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def contract_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns against what the landed lines hold."""
    root, _ = stored.landed(spark, sf_dir)
    return quality.contract_profile(landing.read_landed(spark, root))


def contract_profile_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery with one column missing, one added and one of another type."""
    raw = feed.raw_requests(spark, sf_dir).drop("Division").withColumn("Ward", F.col("Major_Area"))
    return quality.contract_profile(raw.withColumn("Police_District", F.col("Police_District").cast("string")))


def contract_diff_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of that delivery's columns, with the rows that fill each delivered one."""
    raw = feed.raw_requests(spark, sf_dir).select(*stored.RAW_COLUMNS).drop("Division")
    raw = raw.withColumns({"Ward": F.col("Major_Area"), "Police_District": F.col("Police_District").cast("string")})
    changes = quality.contract_diff(raw)
    names = ["Ward", "Police_District"]
    filled = raw.agg(*(F.count(n).alias(n) for n in names)).unpivot([], names, "name", "filled")
    return changes.join(filled, "name", "left")


def contract_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema inferred from the landed lines against the contract.

    JSON has one integer type, so the two declared 32-bit columns arrive as 64-bit ones.
    """
    root, _ = stored.landed(spark, sf_dir)
    inferred = spark.read.option("pathGlobFilter", landing.RAW_FILES).json(root)
    return quality.contract_diff(inferred.drop(*contracts.names(contracts.LANDING_PARTITIONS)))


def schema_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and types found in the landed lines, in the order JSON inference gives them."""
    root, _ = stored.landed(spark, sf_dir)
    inferred = spark.read.option("pathGlobFilter", landing.RAW_FILES).json(root)
    return tables.describe_schema(inferred.drop(*contracts.names(contracts.LANDING_PARTITIONS)))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = feed.valid_requests(spark, sf_dir)
    found = metrics.freshness(cases, F.lit("2002-01-01").cast("timestamp"))
    return found.select(F.unix_millis("newest_created_at").alias("newest_ms"), "age_hours")


# --- star schema -------------------------------------------------------------------


def dim_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.warehouse(spark, sf_dir)["dim_agency"]


def dim_service_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.warehouse(spark, sf_dir)["dim_service_type"]


def dim_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.warehouse(spark, sf_dir)["dim_neighborhood"]


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_as_text(stored.warehouse(spark, sf_dir)["dim_date"])


def dim_neighborhood_lazy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighborhood members straight from the clean cases, as one plan."""
    return dimensions.neighborhoods(feed.valid_requests(spark, sf_dir))


def dim_service_type_after_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.warehouse_after_two(spark, sf_dir)["dim_service_type"]


def dim_neighborhood_after_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.warehouse_after_two(spark, sf_dir)["dim_neighborhood"]


def dim_date_after_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_as_text(stored.warehouse_after_two(spark, sf_dir)["dim_date"])


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.named_facts(stored.warehouse(spark, sf_dir))


def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.named_facts(stored.warehouse_after_two(spark, sf_dir))


def fact_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same cases again leaves the fact as it was."""
    return stored.named_facts(stored.reloaded(spark, sf_dir))


def end_to_end_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.named_facts(stored.run_twice(spark, sf_dir))


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.load_counts(feed.valid_requests(spark, sf_dir))


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempted and inserted rows per table of the second of two loads."""
    root, batch = stored.second_load(spark, sf_dir)
    return load.load_report(spark, root, batch, 2)


# --- dashboard ---------------------------------------------------------------------


def headline_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.headline(stored.warehouse(spark, sf_dir))


def total_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.total_requests(stored.warehouse(spark, sf_dir)["fact_service_request"])


def agencies_represented(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored.warehouse(spark, sf_dir)
    return metrics.agencies_represented(star["fact_service_request"], star["dim_agency"])


def requests_by_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored.warehouse(spark, sf_dir)
    return metrics.by_agency(star["fact_service_request"], star["dim_agency"])


def requests_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored.warehouse(spark, sf_dir)
    return day_as_text(metrics.by_day(star["fact_service_request"], star["dim_date"]))


def requests_by_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored.warehouse(spark, sf_dir)
    return metrics.by_neighborhood(star["fact_service_request"], star["dim_neighborhood"])


def resolution_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = metrics.resolution_hours(stored.warehouse(spark, sf_dir)["fact_service_request"])
    return hours.select(F.col("resolution_hours").cast("double").alias("resolution_hours"))


def resolution_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = metrics.resolution_hours(stored.warehouse(spark, sf_dir)["fact_service_request"])
    return distribution.resolution_stats(hours)


def resolution_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = metrics.resolution_hours(stored.warehouse(spark, sf_dir)["fact_service_request"])
    counts = distribution.value_counts(hours).where(F.col(distribution.VALUE) > 0)
    return distribution.histogram(counts)


def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest keys, as the dashboard shows them."""
    fact = stored.warehouse(spark, sf_dir)["fact_service_request"]
    return metrics.map_points(fact, contracts.MAP_POINT_LIMIT)


def map_points_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.map_points(stored.warehouse(spark, sf_dir)["fact_service_request"])


def slowest_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored.warehouse(spark, sf_dir)
    return metrics.slowest(
        star["fact_service_request"], star["dim_agency"], "agency_key", "agency_name"
    )


def slowest_neighborhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored.warehouse(spark, sf_dir)
    return metrics.slowest(
        star["fact_service_request"], star["dim_neighborhood"], "neighborhood_key", "neighborhood_name"
    )


def resolution_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored.warehouse(spark, sf_dir)
    return metrics.by_year(star["fact_service_request"], star["dim_date"])


# --- extraction and landing --------------------------------------------------------


def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feed.table(spark, sf_dir, "orders")
    fresh = extract.extract(orders, {"o_orderdate": ORDERS_MARK})
    return fresh.select("o_orderkey", time.to_epoch_ms(F.col("o_orderdate")).alias("created_ms"))


def incremental_extract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark has a fraction of a second, which is cut before comparing."""
    events = feed.table(spark, sf_dir, "events")
    return extract.extract(events, {"ts": EVENTS_MARK}).select("event_id", "event_type", "value")


def cold_start_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events")
    return extract.extract(events, {"ts": extract.cold_start_mark(EVENTS_NOW)}).select("event_id")


def full_refresh_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feed.table(spark, sf_dir, "orders")
    return extract.extract(orders, {"o_orderdate": None}).select("o_orderkey", "o_orderstatus")


def changed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New or closed since the mark: a second mark fetches updates of old cases."""
    raw = feed.raw_requests(spark, sf_dir)
    marks = {"Case_Created_Date": ORDERS_MARK, "Case_Closed_Date": ORDERS_MARK}
    return extract.extract(raw, marks).select("OBJECTID", "part_no", "Case_Created_Date", "Case_Closed_Date")


def slice_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.partition_marks(feed.table(spark, sf_dir, "events"), "ts", F.col("event_type"))


def past_slice_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events past the newest one of their own type before the mark."""
    events = feed.table(spark, sf_dir, "events")
    known = events.where(~extract.newer_than(events, "ts", EVENTS_MARK))
    marks = extract.partition_marks(known, "ts", F.col("event_type"))
    return extract.past_partition_marks(events, "ts", F.col("event_type"), marks).select("event_id")


def reconcile_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the orders: a first one, and one that finds only what the mark leaves."""
    orders = feed.table(spark, sf_dir, "orders")
    root = scratch_dir(spark, "reconcile")
    options = {"mark_column": "o_orderdate", "sort_key": "o_orderkey"}
    first = orders.where(F.col("o_orderdate") <= F.lit("1998-06-01").cast("timestamp_ntz"))
    ingest(spark, first, root, run_id="run-1", run_at=stored.FIRST_DAY, full_refresh=True, **options)
    ingest(spark, orders, root, run_id="run-2", run_at=stored.SECOND_DAY, **options)
    return landing.read_manifests(spark, root).select(
        "run_id", "expected_record_count", "actual_record_count", "watermark_before", "watermark_after", "status"
    )


def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a run that writes nothing."""
    events = feed.table(spark, sf_dir, "events")
    manifest = ingest(
        spark,
        events,
        scratch_dir(spark, "dry"),
        run_id="dry",
        run_at=EVENTS_NOW,
        mark_column="ts",
        dry_run=True,
    )
    keep = ["expected_record_count", "actual_record_count", "file_count", "watermark_after", "status"]
    schema = (
        "expected_record_count bigint, actual_record_count bigint, file_count bigint, "
        "watermark_after string, status string"
    )
    return spark.createDataFrame([tuple(manifest[k] for k in keep)], schema)


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = stored.landed(spark, sf_dir)
    return landing.read_landed(spark, root).select(
        *stored.RAW_COLUMNS, "ingest_year", "ingest_month", "ingest_day", "run_id"
    )


def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found, files recorded, and rows landed, one row; the two file views must agree."""
    root, manifest = stored.landed(spark, sf_dir)
    found = landing.inventory_totals(landing.inventory(spark, root, landing.RAW_FILES))
    listed = landing.read_file_lists(spark, root).agg(F.count(F.lit(1)).alias("n")).scalar()
    return found.select(
        (F.col("file_count") == listed).alias("files_match"),
        (F.col("bytes") == F.lit(manifest["bytes_written"])).alias("bytes_match"),
        landing.count_lines(spark, root).scalar().alias("lines"),
    )


def complete_runs_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = stored.landed_with_short_run(spark, sf_dir)
    return landing.read_complete_runs(spark, root).select(*stored.RAW_COLUMNS, "run_id")


def transform_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary row a transform of the landed run reports."""
    _, summary = stored.transformed(spark, sf_dir)
    figures = [
        "raw_rows",
        "clean_rows",
        "duplicates_removed",
        "quarantined_rows",
        "internal_flagged",
        "invalid_coordinates",
        "quality_warnings",
    ]
    return spark.createDataFrame(
        [tuple(summary[f] for f in figures)], ", ".join(f"{f} bigint" for f in figures)
    )


def published_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table a transform of the landed run publishes."""
    root, _ = stored.transformed(spark, sf_dir)
    return as_numbers(read_clean(spark, root))


def quarantined_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that transform held back, with the checks they break."""
    root, _ = stored.transformed(spark, sf_dir)
    bad = quarantined_rows(spark, snapshots.table_path(spark, root, "requests"))
    return bad.select("OBJECTID", F.array_join("problems", ",").alias("problems"))


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.named_facts(stored.streamed(spark, sf_dir)).drop("loaded_ms")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream's batches set apart, after loads and expiries that came later."""
    held = load.read_quarantine(spark, stored.streamed_root(spark, sf_dir))
    number = F.regexp_extract("batch_id", "-([0-9]+)$", 1).cast("int") + 1
    return held.select("OBJECTID", F.array_join("problems", ",").alias("problems"), number.alias("delivery"))


def parked_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that never passes is parked, and the later ones are loaded."""
    root = stored.parked(spark, sf_dir)
    facts = stored.named_facts(load.read_star(spark, f"{root}/warehouse"))
    held = holding.parked_runs(spark, root).agg(F.array_join(F.sort_array(F.collect_list("run_id")), ","))
    return facts.withColumn("parked", held.scalar())


def recovered_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failed run's rows come with the next run that succeeds."""
    return stored.named_facts(stored.recovered(spark, sf_dir))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with another checkpoint neither skips nor repeats cases."""
    return stored.named_facts(stored.restarted(spark, sf_dir)).drop("loaded_ms")


def empty_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run without new rows: its manifest says so, and the one loaded version stays."""
    root = stored.idle_run(spark, sf_dir)
    runs = landing.read_manifests(spark, f"{root}/raw").agg(
        F.count(F.lit(1)).alias("n_runs"), F.sum("actual_record_count").alias("n_landed")
    )
    cases = load.read_table(spark, f"{root}/warehouse", "fact_service_request").agg(F.count(F.lit(1)).alias("n_cases"))
    versions = snapshots.commits(spark, f"{root}/warehouse").agg(F.count(F.lit(1)).alias("n_versions"))
    return runs.select("n_runs", "n_landed", cases.scalar().alias("n_cases"), versions.scalar().alias("n_versions"))


def preview_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview written as CSV and read back."""
    path = scratch_dir(spark, "preview")
    tables.write_preview(feed.valid_requests(spark, sf_dir), path)
    read = spark.read.option("header", True).csv(path)
    return read.select(F.col("OBJECTID").cast("long"), "Case_Status", "Agency", "Type", "Topic", "Neighborhood", "is_closed")


def landed_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the delivery that landed in key order, and files that reach into the next one."""
    root = stored.landed_with_short_run(spark, sf_dir)
    rows = landing.read_complete_runs(spark, root, file_path=True)
    rows = rows.select("OBJECTID", F.col(landing.FILE_PATH).alias("file"))
    files = rows.groupBy("file").agg(
        F.min("OBJECTID").alias("low"), F.max("OBJECTID").alias("high"), F.count(F.lit(1)).alias("n")
    )
    order = Window.orderBy("low", "high")
    files = files.withColumn("reaches", F.coalesce(F.col("high") > F.lead("low").over(order), F.lit(False)))
    return files.agg(F.sum("n").alias("n_rows"), F.count_if("reaches").alias("n_overlaps"))


# --- comparisons between deliveries ------------------------------------------------


def key_discontinuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feed.raw_requests(spark, sf_dir)
    return drift.key_ranges(raw, ["ingest_year", "ingest_month"])


def volume_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events")
    daily = drift.rows_per_slice(events, time.date_key(F.col("ts")), "date_key")
    scored = drift.volume_anomalies(daily, "date_key", "n_rows", limit=1.5)
    return scored.withColumns(
        {"expected_rows": F.round("expected_rows", 6), "score": F.round("score", 6)}
    )


# --- scalar functions --------------------------------------------------------------


def date_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events")
    day = F.to_date("ts")
    attributes = time.date_attributes(day).items()
    return day_as_text(events.select("event_id", *(c.alias(n) for n, c in attributes)))


def utc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing partition values and mark texts of every event time."""
    events = feed.table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        *(c.alias(n) for n, c in time.landing_partition(at).items()),
        time.utc_iso(at).alias("iso"),
        time.utc_seconds_text(at).alias("seconds"),
    )


def guarded_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions that must survive NaN, out-of-range and unreadable values."""
    events = feed.table(spark, sf_dir, "events")
    nan = F.lit(float("nan"))
    value = F.when(F.col("event_id") % 7 == 0, nan).otherwise(-F.col("value"))
    wide = F.when(F.col("event_id") % 5 == 0, F.lit(1e12)).otherwise(value)
    piece = F.substring("props", 7, 2)
    return events.select(
        "event_id",
        numbers.int_or_null(wide).alias("whole"),
        numbers.double_or_null(value).alias("real"),
        numbers.int_or_null(piece).alias("whole_from_text"),
        numbers.double_or_null(piece).alias("real_from_text"),
        numbers.stored_hours(value).cast("double").alias("hours"),
        numbers.false_if_null(F.when(F.col("event_id") % 3 > 0, F.col("value") > 10)).alias("flag"),
    )


def size_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feed.table(spark, sf_dir, "documents")
    scale = F.pow(F.lit(32.0), (F.col("doc_id") % 7).cast("double")).cast("long")
    return documents.select("doc_id", text.human_size(F.col("n_chars") * scale).alias("size"))


def share_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events")
    share = F.count_if(F.col("value") > 10) / F.count(F.lit(1))
    return events.groupBy("user_id").agg(text.percent_text(share).alias("share"))


def registered() -> dict:
    """Every query of this module by name."""
    return {
        query.__name__: query
        for query in (
            agency_report_from_raw,
            dedup_latest,
            dedup_dirty,
            dedup_null_as_key,
            clean_strings,
            epoch_to_ts,
            derive_flags,
            clean_requests,
            probable_copies_removed,
            transform_summary,
            duplicate_count,
            preview_latest,
            quality_report,
            quality_report_dirty,
            quality_report_repeated_keys,
            quarantine_counts,
            contract_profile,
            contract_diff,
            schema_describe,
            freshness,
            dim_agency,
            dim_service_type,
            dim_neighborhood,
            dim_date,
            dim_neighborhood_lazy,
            dim_service_type_after_two,
            dim_neighborhood_after_two,
            dim_date_after_two,
            fact_load,
            fact_upsert,
            fact_reload,
            end_to_end_runs,
            load_counts,
            load_report,
            headline_figures,
            total_requests,
            agencies_represented,
            requests_by_agency,
            requests_by_day,
            requests_by_neighborhood,
            resolution_population,
            resolution_stats,
            resolution_histogram,
            map_points,
            slowest_agencies,
            slowest_neighborhoods,
            resolution_by_year,
            incremental_extract,
            incremental_extract_events,
            cold_start_extract,
            full_refresh_extract,
            changed_extract,
            slice_marks,
            past_slice_marks,
            reconcile_run,
            dry_run,
            landing_roundtrip,
            landing_inventory,
            complete_runs_only,
            transform_run,
            published_requests,
            quarantined_requests,
            stream_upsert,
            stream_quarantine,
            parked_run,
            recovered_runs,
            stream_restart,
            empty_run,
            preview_file,
            landed_key_ranges,
            quality_report_missing_columns,
            damaged_lines_report,
            contract_profile_delivery,
            contract_diff_delivery,
            map_points_all,
            key_discontinuity,
            volume_anomalies,
            date_attributes,
            utc_texts,
            guarded_numbers,
            size_texts,
            share_texts,
        )
    }
