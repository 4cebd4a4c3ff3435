from __future__ import annotations

import gzip
import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.operators import clean
from civicflow.plans import holding, load
from civicflow.plans.end_to_end import ShortReadError, run
from civicflow.plans.ingest import ingest
from civicflow.plans.load import read_star
from civicflow.sources import entry_log, extract, landing, snapshots, tables

UTC = timezone.utc
NOW = datetime(2024, 7, 4, 9, 30, tzinfo=UTC)
NOW_MS = int(NOW.timestamp() * 1000)
HOUR = 3_600_000


@pytest.fixture
def source(cases):
    """Cases created the given hours before ``NOW``, keys from 1."""
    return lambda *ages: cases(
        *({"OBJECTID": i, "Case_Created_Date": NOW_MS - age * HOUR} for i, age in enumerate(ages, 1))
    )


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "raw")


def files(root, pattern="ingest_year=*/**/*.json.gz"):
    return sorted(Path(root).glob(pattern))


def test_a_run_lands_records_and_advances_the_mark(spark, source, root):
    manifest = ingest(spark, source(5, 3, 1), root, run_id="r1", run_at=NOW)
    assert manifest["status"] == "ok"
    assert manifest["expected_record_count"] == manifest["actual_record_count"] == 3
    assert manifest["file_count"] == len(files(root)) > 0
    assert manifest["bytes_written"] == sum(f.stat().st_size for f in files(root))
    assert landing.read_mark(spark, root) == NOW - timedelta(hours=1)
    stored = landing.read_manifests(spark, root).first().asDict()
    assert stored == manifest


def test_manifests_have_all_their_keys(spark, source, root):
    manifest = ingest(spark, source(1), root, run_id="r1", run_at=NOW)
    assert list(manifest) == [c.split(" ")[0] for c in landing.MANIFEST_SCHEMA.split(", ")]


def test_directories_name_the_utc_day_of_the_run(spark, source, root):
    late = datetime(2024, 7, 4, 23, 0, tzinfo=timezone(timedelta(hours=-6)))
    ingest(spark, source(1), root, run_id="r1", run_at=late, full_refresh=True)
    assert Path(root, "ingest_year=2024/ingest_month=07/ingest_day=05/run_id=r1").is_dir()


def test_landed_lines_are_whole_json_objects_with_nulls(spark, source, root):
    ingest(spark, source(1), root, run_id="r1", run_at=NOW)
    lines = [line for f in files(root) for line in gzip.open(f, "rt")]
    record = json.loads(lines[0])
    assert set(record) == set(contracts.names(contracts.RAW_FEED))
    assert record["Case_Closed_Date"] is None


def test_files_hold_at_most_the_asked_number_of_rows_in_key_order(spark, source, root):
    ingest(spark, source(*range(1, 26)), root, run_id="r1", run_at=NOW, rows_per_file=4, sort_key="OBJECTID")
    keys = [[json.loads(line)["OBJECTID"] for line in gzip.open(f, "rt")] for f in files(root)]
    assert max(len(k) for k in keys) <= 4
    assert all(k == sorted(k) for k in keys)
    assert sorted(sum(keys, [])) == list(range(1, 26))


def test_a_hot_key_is_landed_by_several_tasks(spark, cases):
    df = cases(*[{"OBJECTID": 1}] * 60, *[{"OBJECTID": i} for i in range(2, 30)]).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = landing.in_key_order(df, "OBJECTID").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["task"] for r in tasks if r["OBJECTID"] == 1}) > 1
    assert len(tasks) == 88


def test_the_second_run_takes_only_what_is_new(spark, source, root):
    ingest(spark, source(5, 3), root, run_id="r1", run_at=NOW)
    manifest = ingest(spark, source(5, 3, 2, 1), root, run_id="r2", run_at=NOW)
    assert manifest["actual_record_count"] == 2
    assert landing.read_landed(spark, root).count() == 4


def test_a_repeated_run_replaces_its_own_files(spark, source, root):
    for _ in range(2):
        ingest(spark, source(5, 3), root, run_id="r1", run_at=NOW, full_refresh=True)
    assert landing.read_landed(spark, root).count() == 2
    assert landing.read_manifests(spark, root).count() == 1


def test_a_cold_start_looks_back_a_fixed_time(spark, source, root):
    day = 24
    manifest = ingest(spark, source(31 * day, 29 * day), root, run_id="r1", run_at=NOW)
    assert manifest["actual_record_count"] == 1
    assert manifest["watermark_before"] == (NOW - timedelta(days=30)).isoformat()


def test_a_cold_start_without_rows_still_stores_its_bound(spark, source, root):
    ingest(spark, source(2000), root, run_id="r1", run_at=NOW)
    assert landing.read_mark(spark, root) == NOW - timedelta(days=30)


def test_a_full_refresh_ignores_the_mark(spark, source, root):
    ingest(spark, source(1), root, run_id="r1", run_at=NOW)
    manifest = ingest(spark, source(9000, 1), root, run_id="r2", run_at=NOW, full_refresh=True)
    assert (manifest["where_clause"], manifest["actual_record_count"]) == ("1=1", 2)


def test_a_short_read_keeps_files_and_manifest_but_not_the_mark(spark, source, root):
    manifest = ingest(spark, source(3, 1), root, run_id="r1", run_at=NOW, expected=100)
    assert manifest["status"] == "short_read"
    assert landing.read_mark(spark, root) is None
    assert landing.read_landed(spark, root).count() == 2
    assert landing.read_complete_runs(spark, root).count() == 0


def test_more_rows_than_announced_are_fine(spark, source, root):
    assert ingest(spark, source(3, 1), root, run_id="r1", run_at=NOW, expected=1)["status"] == "ok"


def test_a_dry_run_counts_and_writes_nothing(spark, source, root):
    ingest(spark, source(1), root, run_id="r1", run_at=NOW)
    before = sorted(Path(root).rglob("*"))
    manifest = ingest(spark, source(5, 1), root, run_id="r2", run_at=NOW, dry_run=True)
    assert (manifest["dry_run"], manifest["file_count"], manifest["actual_record_count"]) == (True, 0, 2)
    assert sorted(Path(root).rglob("*")) == before


def test_the_mark_never_moves_back(spark, source, root):
    ingest(spark, source(1), root, run_id="r1", run_at=NOW)
    ingest(spark, source(5), root, run_id="r2", run_at=NOW, full_refresh=True)
    ingest(spark, source(5), root, run_id="r3", run_at=NOW)
    assert landing.read_mark(spark, root) == NOW - timedelta(hours=1)


def test_a_second_mark_fetches_cases_closed_since(spark, cases, root):
    def feed(closed_age):
        closed = None if closed_age is None else NOW_MS - closed_age * HOUR
        return cases(
            {"OBJECTID": 1, "Case_Created_Date": NOW_MS - 9 * HOUR, "Case_Closed_Date": closed},
            {"OBJECTID": 2, "Case_Created_Date": NOW_MS - 8 * HOUR},
        )

    options = {"run_at": NOW, "update_columns": ["Case_Closed_Date"]}
    assert ingest(spark, feed(None), root, run_id="r1", **options)["actual_record_count"] == 2
    second = ingest(spark, feed(2), root, run_id="r2", **options)
    assert (second["actual_record_count"], second["status"]) == (1, "ok")
    assert ingest(spark, feed(2), root, run_id="r3", **options)["actual_record_count"] == 0
    assert landing.read_mark(spark, root) == NOW - timedelta(hours=8)
    assert landing.read_mark(spark, root, "/Case_Closed_Date") == NOW - timedelta(hours=2)


def test_a_run_without_new_rows_in_key_order(spark, source, root, tmp_path):
    source(3, 1).write.parquet(str(tmp_path / "src"))
    stored = spark.read.parquet(str(tmp_path / "src"))
    for run_id, rows in (("r1", 2), ("r2", 0)):
        manifest = ingest(spark, stored, root, run_id=run_id, run_at=NOW, sort_key="OBJECTID")
        assert (manifest["actual_record_count"], manifest["status"]) == (rows, "ok")
    assert landing.read_mark(spark, root) == NOW - timedelta(hours=1)
    assert landing.read_landed(spark, root).count() == 2


def test_marks_of_slices_are_separate(spark, source, root):
    ingest(spark, source(1), root, run_id="r1", run_at=NOW, slice_name="march")
    assert landing.read_mark(spark, root, "march") == NOW - timedelta(hours=1)
    assert landing.read_mark(spark, root, "april") is None


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "timestamp_ntz"])
def test_the_mark_is_strict_and_cut_to_seconds_for_every_column_type(spark, kind):
    base = spark.createDataFrame([(-1,), (0,), (1,), (999,), (1000,)], "offset bigint")
    ms = F.col("offset") + NOW_MS
    df = base.withColumn("at", ms if kind == "bigint" else F.timestamp_millis(ms).cast(kind))
    mark = NOW + timedelta(milliseconds=999)
    kept = df.where(extract.newer_than(df, "at", mark)).select("offset").collect()
    assert sorted(r[0] for r in kept) == [1, 999, 1000]


def test_an_overlap_reads_rows_on_the_mark_again(spark, source):
    df = source(2, 1, 0)
    mark = NOW - timedelta(hours=1)
    assert extract.extract(df, {"Case_Created_Date": mark}).count() == 1
    assert extract.extract(df, {"Case_Created_Date": mark}, timedelta(minutes=1)).count() == 2


def test_the_mark_reaches_the_parquet_scan(spark, source, tmp_path):
    source(3, 2, 1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    fresh = extract.extract(df, {"Case_Created_Date": NOW}).select("OBJECTID")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(Case_Created_Date" in plan
    assert "ReadSchema: struct<OBJECTID:bigint,Case_Created_Date:bigint>" in plan


def test_slices_are_read_past_their_own_marks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1), ("c", 1)], "kind string, at bigint")
    marks = spark.createDataFrame([("a", 3), ("b", 1)], "slice string, mark_ms bigint")
    fresh = extract.past_partition_marks(df, "at", F.col("kind"), marks)
    assert sorted(map(tuple, fresh.collect())) == [("a", 5), ("c", 1)]


def write_lines(root, text, run="r1", name="part-0.jsonl.gz"):
    folder = Path(root, f"ingest_year=2024/ingest_month=07/ingest_day=04/run_id={run}")
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt") as out:
        out.write(text)


def test_reading_tolerates_drift_and_keeps_damaged_lines(spark, root):
    write_lines(root, '{"OBJECTID": 1, "Brand_New": "x"}\n{"OBJECTID": 2, "Latitude": "north"}\n{broken\n\n')
    rows = {r["OBJECTID"]: r for r in landing.read_landed(spark, root).collect()}
    assert set(rows) == {1, 2, None}
    assert rows[1]["_corrupt_record"] is None and rows[1]["Agency"] is None
    assert rows[2]["Latitude"] is None and "north" in rows[2]["_corrupt_record"]
    assert rows[None]["_corrupt_record"] == "{broken"
    assert landing.count_lines(spark, root).first()["n"] == 3


def test_row_numbers_of_a_scan_repeat(spark, source, root):
    ingest(spark, source(*range(1, 40)), root, run_id="r1", run_at=NOW, rows_per_file=3)
    runs = [
        {r["OBJECTID"]: r[landing.ROW_ID] for r in landing.read_landed(spark, root, row_id=True).collect()}
        for _ in range(2)
    ]
    assert runs[0] == runs[1] and len(set(runs[0].values())) == 39


def test_partition_values_stay_text(spark, root):
    write_lines(root, '{"OBJECTID": 1}\n')
    row = landing.read_landed(spark, root).first()
    assert (row["ingest_year"], row["ingest_month"], row["ingest_day"], row["run_id"]) == ("2024", "07", "04", "r1")


def test_a_zone_without_run_directories_is_read_too(spark, root):
    folder = Path(root, "ingest_year=2024/ingest_month=07/ingest_day=04")
    folder.mkdir(parents=True)
    for run in ("a", "b"):
        with gzip.open(folder / f"{run}_part-00000.jsonl.gz", "wt") as out:
            out.write('{"OBJECTID": 1, "Agency": " %s "}\n' % run)
    rows = landing.read_landed(spark, root).collect()
    assert [(r["ingest_day"], r["run_id"]) for r in rows] == [("04", None)] * 2
    kept = clean.clean_requests(landing.read_landed(spark, root, row_id=True), row_id=landing.ROW_ID)
    assert [r["Agency"] for r in kept.collect()] == ["b"]


def test_a_day_filter_prunes_directories(spark, root):
    write_lines(root, '{"OBJECTID": 1}\n')
    df = landing.read_landed(spark, root).where("ingest_day = '04'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_day" in plan


def test_other_files_below_the_root_are_not_rows(spark, root):
    write_lines(root, '{"OBJECTID": 1}\n')
    write_lines(root, '{"OBJECTID": 2}\n', name="notes.txt.gz")
    write_lines(f"{root}/_manifests", '{"OBJECTID": 3}\n')
    assert [r["OBJECTID"] for r in landing.read_landed(spark, root).collect()] == [1]


def test_history_is_landed_under_its_own_days(spark, source, root):
    landing.append_history(source(0, 24), root, F.timestamp_millis("Case_Created_Date"), "backfill")
    days = {(r["ingest_month"], r["ingest_day"], r["run_id"]) for r in landing.read_landed(spark, root).collect()}
    assert days == {("07", "04", "backfill"), ("07", "03", "backfill")}


def test_the_inventory_lists_sizes_without_reading(spark, source, root):
    ingest(spark, source(3, 1), root, run_id="r1", run_at=NOW)
    listed = landing.inventory(spark, root, landing.RAW_FILES)
    assert sorted(r["length"] for r in listed.collect()) == sorted(f.stat().st_size for f in files(root))
    totals = landing.inventory_totals(listed).first()
    assert totals["file_count"] == len(files(root)) and totals["size"].endswith("B")
    assert landing.inventory_totals(landing.inventory(spark, f"{root}/_manifests", "*.json")).first()["file_count"] == 1


def test_an_empty_or_missing_root_has_no_files(spark, tmp_path):
    assert not landing.has_files(spark, str(tmp_path / "nowhere"))
    assert not landing.has_files(spark, str(tmp_path))


def test_a_schema_is_described(spark):
    rows = tables.describe_schema(spark.createDataFrame([(1, "x")], "a int, b string")).collect()
    assert [tuple(r) for r in rows] == [(1, "a", "int", True), (2, "b", "string", True)]


def test_all_stages_in_order(spark, source, tmp_path):
    root = str(tmp_path / "all")
    result = run(spark, source(5, 3, 1), root, run_id="r1", run_at=NOW)
    assert (result["summary"]["clean_rows"], result["version"]) == (3, 1)
    again = run(spark, source(5, 3, 1, 0), root, run_id="r2", run_at=NOW)
    assert (again["manifest"]["actual_record_count"], again["summary"]["clean_rows"], again["version"]) == (1, 4, 2)
    assert read_star(spark, f"{root}/warehouse")["fact_service_request"].count() == 4


def test_an_incremental_run_transforms_only_its_own_files(spark, source, tmp_path):
    root = str(tmp_path / "all")
    run(spark, source(5, 3, 1), root, run_id="r1", run_at=NOW, incremental=True)
    again = run(spark, source(5, 3, 1, 0), root, run_id="r2", run_at=NOW, incremental=True)
    assert (again["summary"]["raw_rows"], again["version"]) == (1, 2)
    assert read_star(spark, f"{root}/warehouse")["fact_service_request"].count() == 4


def test_run_ids_sort_by_time_and_differ(spark):
    first, second = landing.new_run_id(NOW), landing.new_run_id(NOW)
    assert first != second and first.startswith("20240704T093000Z-") and len(first) == 25


def test_overwriting_a_table_removes_stale_parts(spark, cases, tmp_path):
    path = str(tmp_path / "t")
    for count in (8, 2):
        rows = clean.clean_requests(cases(*[{"OBJECTID": i} for i in range(count)])).repartition(count)
        tables.write_parquet(rows, path)
    read = tables.read_processed(spark, path)
    assert (read.count(), read.columns) == (2, tables.PROCESSED_COLUMNS)


def test_a_short_read_keeps_later_stages_from_running(spark, source, tmp_path):
    with pytest.raises(ShortReadError):
        run(spark, source(1), str(tmp_path / "all"), run_id="r1", run_at=NOW, expected=50)
    assert not (tmp_path / "all" / "processed").exists()


def test_a_failing_run_is_parked_and_later_ones_load(spark, source, tmp_path):
    root = str(tmp_path / "all")
    options = {"incremental": True, "park_failures": True, "full_refresh": True}
    bad = source(1, 2).withColumn("Case_Closed_Date", F.col("Case_Created_Date") - 1)
    first = run(spark, bad, root, run_id="r1", run_at=NOW, **options)
    assert (first["parked"], first["version"]) == (["r1"], None)
    second = run(spark, source(5, 3), root, run_id="r2", run_at=NOW, **options)
    third = run(spark, source(5, 3, 1), root, run_id="r3", run_at=NOW, **options)
    assert (second["parked"], second["version"], third["version"]) == ([], 1, 2)
    held = holding.parked_runs(spark, root).collect()
    assert [r["run_id"] for r in held] == ["r1"] and "closed_at before created_at" in held[0]["reason"]
    assert snapshots.commits(spark, f"{root}/warehouse").where(F.array_contains("runs", "r1")).isEmpty()
    holding.release(spark, root, "r1")
    assert holding.parked_runs(spark, root).isEmpty()
    again = run(spark, source(5), root, run_id="r4", run_at=NOW, **options)  # still fails, is parked again
    assert again["parked"] == ["r1"] and again["version"] == 3
    holding.release(spark, root, "r1")
    mended = {"quarantine": True, "max_quarantined": 1.0}
    last = run(spark, source(5), root, run_id="r5", run_at=NOW, transform_options=mended, **options)
    assert last["parked"] == [] and holding.parked_runs(spark, root).isEmpty()
    assert load.read_quarantine(spark, f"{root}/warehouse").count() == 2


def test_complete_runs_are_one_scan_pruned_by_their_manifests(spark, source, root):
    for number, expected in ((1, None), (2, 10**6), (3, None)):
        ingest(spark, source(number), root, run_id=f"r{number}", run_at=NOW, full_refresh=True, expected=expected)
    rows = landing.read_complete_runs(spark, root)
    assert sorted({r["run_id"] for r in rows.collect()}) == ["r1", "r3"]
    plan = executed_plan(rows)
    assert "dynamicpruning" in plan
    assert landing.read_complete_runs(spark, f"{root}/none").count() == 0


def test_fifty_runs_leave_short_logs(spark, root, monkeypatch):
    """Marks and manifests are read from one snapshot and the entries behind it."""
    blank = {name: None for name, _ in landing._MANIFEST}
    for number in range(50):
        landing.append_mark(spark, root, NOW_MS + (number % 40) * 1000, f"r{number}", f"s{number % 2}")
        landing.write_manifest(spark, root, f"r{number % 45}", blank | {"status": "ok", "actual_record_count": number})
    read, plain = [], entry_log.read_text
    monkeypatch.setattr(entry_log, "read_text", lambda s, path: read.append(path) or plain(s, path))
    assert landing.read_mark(spark, root, "s1") == NOW.replace(microsecond=0) + timedelta(seconds=39)
    assert landing.read_mark(spark, root, "s0") == NOW.replace(microsecond=0) + timedelta(seconds=38)
    assert 0 < len(read) <= 2 * (entry_log.SNAPSHOT_EVERY + 1)
    assert len(entry_log.files(spark, f"{root}/_manifests")) <= entry_log.SNAPSHOT_EVERY + 1
    marks = {r["slice"]: (r["updated_by_run"], datetime.fromisoformat(r["watermark"]).second) for r in landing.read_marks(spark, root).collect()}
    assert marks == {"s0": ("r38", (NOW + timedelta(seconds=38)).second), "s1": ("r39", (NOW + timedelta(seconds=39)).second)}
    found = {r["run_id"]: r["actual_record_count"] for r in landing.read_manifests(spark, root).collect()}
    assert found == {f"r{i}": i + 45 if i < 5 else i for i in range(45)}


def test_writers_at_the_same_moment_lose_no_entry(spark, root):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: entry_log.append(spark, f"{root}/log", [{"i": i}]), range(40)))
    assert sorted(numbers) == list(range(1, 41))
    assert sorted(line["i"] for line in entry_log.lines(spark, entry_log.files(spark, f"{root}/log"))) == list(range(40))


def test_a_source_is_read_once(spark, source, root, tmp_path, monkeypatch):
    """Without a count of its own only footers are asked, or nothing at all."""
    source(*range(7)).write.parquet(str(tmp_path / "table"))
    whole = spark.read.parquet(str(tmp_path / "table"))
    recent = whole.where(F.col("OBJECTID") > 3)
    assert extract.announced_rows(whole.drop("Topic")) == 7
    assert extract.announced_rows(recent) is None and extract.announced_rows(whole.limit(2)) is None
    assert extract.announced_rows(spark.range(3)) is None
    footers = whole.groupBy().count()
    assert "ReadSchema: struct<>" in executed_plan(footers)
    manifest = ingest(spark, whole, root, run_id="r1", run_at=NOW, full_refresh=True, sort_key="OBJECTID")
    assert (manifest["expected_record_count"], manifest["actual_record_count"], manifest["status"]) == (7, 7, "ok")
    with monkeypatch.context() as patch:
        patch.setattr(type(whole), "count", lambda df: pytest.fail("counted"))
        manifest = ingest(spark, recent, root, run_id="r2", run_at=NOW, full_refresh=True)
        assert (manifest["expected_record_count"], manifest["status"]) == (4, "ok")
    manifest = ingest(spark, recent, root, run_id="r3", run_at=NOW, full_refresh=True, count_first=True)
    assert (manifest["expected_record_count"], manifest["status"]) == (4, "ok")
