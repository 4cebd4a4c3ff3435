"""Extract past the mark, land, reconcile, record, and only then advance the mark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.session import configure, sized_shuffles
from civicflow.sources import extract, landing

# Rows in memory against the files of the source.
EXPANSION = 10.0


def ingest(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    *,
    run_id: str,
    run_at: datetime,
    mark_column: str = "Case_Created_Date",
    update_columns: Sequence[str] = (),
    full_refresh: bool = False,
    dry_run: bool = False,
    lookback_days: int = contracts.COLD_START_DAYS,
    overlap: timedelta = timedelta(0),
    rows_per_file: int = landing.ROWS_PER_FILE,
    sort_key: str | None = None,
    expected: int | None = None,
    count_first: bool = False,
    slice_name: str = "",
    source_name: str = "",
) -> dict:
    """One ingestion run; returns its manifest.

    ``update_columns`` (a closing or modification time) add rows that changed after their
    creation was passed; each column has a mark of its own.

    ``expected`` is the source's own row count if it reports one; a whole Parquet or ORC table is
    asked for it by its file footers. A run that lands less is a ``short_read``: its files stay, its
    manifest says so, and the mark does not move, so the next run reads the window again. Of a
    source that states no count the rows are read once, and what the writing tasks saw is all there
    is to expect; ``count_first`` reads such a source twice, to compare two readings of it.
    """
    configure(spark)
    columns = {mark_column: slice_name, **{c: f"{slice_name}/{c}" for c in update_columns}}
    since: dict[str, datetime | None] = {}
    for column, state in columns.items():
        stored = None if full_refresh or dry_run else landing.read_mark(spark, root, state)
        cold = None if full_refresh else extract.cold_start_mark(run_at, lookback_days)
        since[column] = stored or cold

    wanted = extract.extract(source, since, overlap)
    if expected is None:
        expected = wanted.count() if count_first else extract.announced_rows(wanted)

    directory = landing.run_directory(run_id, run_at)
    totals = [F.count(F.lit(1)).alias("rows")]
    for column, mark in since.items():
        totals.append(extract.high_water(wanted, column, mark).alias(f"mark_{column}"))
    if dry_run:
        seen = wanted.agg(*totals).first().asDict()
        written = {"file_count": 0, "bytes": 0}
    else:
        # The figures are taken in the writing tasks themselves, after any shuffle; Spark
        # counts a finished result task once even if an executor is lost.
        figures = Observation()
        ordered = landing.in_key_order(wanted, sort_key) if sort_key else wanted
        with sized_shuffles(wanted, EXPANSION):
            landing.write_landing(
                ordered.observe(figures, *totals), f"{root}/{directory}", rows_per_file
            )
        seen = figures.get
        files = landing.inventory(spark, f"{root}/{directory}", landing.RAW_FILES)
        landing.write_file_list(files, root, run_id)
        listed = landing.read_file_lists(spark, root, run_id)
        written = landing.inventory_totals(listed).first().asDict()

    expected = seen["rows"] if expected is None else expected
    marks = {column: seen[f"mark_{column}"] for column in columns}
    status = "short_read" if seen["rows"] < expected else "ok"
    manifest = {
        "run_id": run_id,
        "run_started_at": run_at.astimezone(timezone.utc).isoformat(),
        "run_finished_at": datetime.now(timezone.utc).isoformat(),
        "source": source_name,
        "where_clause": " OR ".join(_predicate_text(c, m, overlap) for c, m in since.items()),
        "expected_record_count": expected,
        "actual_record_count": seen["rows"],
        "file_count": written["file_count"],
        "bytes_written": written["bytes"],
        "files": [] if dry_run else [directory],
        "watermark_before": _iso(since[mark_column]),
        "watermark_after": _iso(_from_ms(marks[mark_column])),
        "full_refresh": full_refresh,
        "dry_run": dry_run,
        "status": status,
    }
    if not dry_run:
        landing.write_manifest(spark, root, run_id, manifest)
        for column, state in columns.items():
            if status == "ok" and marks[column] is not None:
                landing.append_mark(spark, root, marks[column], run_id, state)
    return manifest


def _predicate_text(column: str, since: datetime | None, overlap: timedelta) -> str:
    """The extraction window as readable SQL, for the manifest."""
    if since is None:
        return "1=1"
    bound = since.astimezone(timezone.utc) - overlap
    return f"{column} > TIMESTAMP '{bound:%Y-%m-%d %H:%M:%S}'"


def _from_ms(mark_ms: int | None) -> datetime | None:
    if mark_ms is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=mark_ms)


def _iso(mark: datetime | None) -> str | None:
    return mark.astimezone(timezone.utc).isoformat() if mark else None
