"""The raw landing zone: immutable gzip JSON lines, run manifests and the mark's history.

Layout below a root::

    ingest_year=2024/ingest_month=07/ingest_day=04/run_id=<run>/part-*.json.gz
    _manifests/                a log of one summary row per run
    _files/run_id=<run>/       one row per landed file
    _state/                    a log of the advances of the high-water mark

A run has a directory of its own, so repeating a run replaces its files and never those
of another run.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.functions import text, time
from civicflow.sources import entry_log
from civicflow.sources.tables import each_file, path_exists, read_json_log, run_paths

ROW_ID = "_row_id"
FILE_PATH = "_file_path"
RAW_FILES = "*.{json,jsonl}.gz"
ROWS_PER_FILE = 1_000_000

MANIFEST_SCHEMA = contracts.MANIFEST_SCHEMA
_MANIFEST = [column.split(" ", 1) for column in MANIFEST_SCHEMA.split(", ")]
FILE_SCHEMA = "run_id string, path string, length bigint"


def new_run_id(run_at: datetime) -> str:
    """UTC time of the run and eight random hexadecimal digits."""
    return f"{run_at.astimezone(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def run_directory(run_id: str, run_at: datetime) -> str:
    day = run_at.astimezone(timezone.utc)
    return f"ingest_year={day:%Y}/ingest_month={day:%m}/ingest_day={day:%d}/run_id={run_id}"


def run_directories(spark: SparkSession, root: str) -> list[str]:
    """Directories of all runs that landed, below the root."""
    levels = "/".join(f"{name}=*" for name in contracts.names(contracts.LANDING_PARTITIONS))
    return run_paths(spark, root, levels)


def in_key_order(df: DataFrame, key: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``key``: every landed file holds one key range.

    Content and source partition extend the range key, so one key with a large share of
    the rows, exact copies included, is spread over several tasks.
    """
    spread = df.withColumns({"_content": F.xxhash64(*df.columns), "_part": F.spark_partition_id()})
    ranged = spread.repartitionByRange(key, "_content", "_part").drop("_content", "_part")
    return ranged.sortWithinPartitions(key)


def write_landing(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write one run's rows as gzip JSON lines, NULL fields included."""
    (
        df.write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .option("ignoreNullFields", "false")
        .json(path)
    )


def append_history(df: DataFrame, root: str, landed_at: Column, run_id: str) -> None:
    """Append older deliveries under the landing day of each row, as one run.

    The rebalance hint sends a day to few tasks, and splits a day that is too large for one.
    """
    levels = {**time.landing_partition(landed_at), "run_id": F.lit(run_id)}
    (
        df.withColumns(levels)
        .hint("rebalance", *[F.col(c) for c in levels])
        .write.mode("append")
        .partitionBy(*levels)
        .option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .json(root)
    )


def landing_schema(corrupt: bool = True) -> str:
    columns = [*contracts.RAW_FEED, *contracts.LANDING_PARTITIONS]
    if corrupt:
        columns = [*columns, (contracts.CORRUPT_COLUMN, "string")]
    return contracts.ddl(columns)


def read_landed(
    spark: SparkSession,
    root: str,
    *,
    row_id: bool = False,
    file_path: bool = False,
    paths: list[str] | None = None,
) -> DataFrame:
    """All landed rows under the declared schema, with partition columns and damaged lines.

    Unknown fields are dropped, missing and mistyped ones NULL; a line that does not fit
    keeps its text in ``_corrupt_record``. Underscore directories are not read. Partition
    filters prune directories. ``row_id`` adds a number per row that is the same whenever
    a scan task is repeated (it counts within the task's fixed file range), ``file_path`` the
    file that a row comes from.
    """
    landed = (
        spark.read.schema(landing_schema())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", contracts.CORRUPT_COLUMN)
        .option("pathGlobFilter", RAW_FILES)
        .option("basePath", root)
        .json(paths if paths is not None else root)
    )
    if file_path:
        landed = landed.withColumn(FILE_PATH, F.col("_metadata.file_path"))
    return landed.withColumn(ROW_ID, scan_position()) if row_id else landed


def scan_position() -> Column:
    """A number per row, to be added directly on a file scan: only there does a repeated
    task see the same rows in the same order."""
    return F.monotonically_increasing_id()


def empty_landing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], landing_schema())


def count_lines(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """Number of landed rows, without parsing them (one row, ``n``)."""
    lines = spark.read.option("pathGlobFilter", RAW_FILES).text(paths if paths is not None else root)
    return lines.where(F.trim("value") != "").agg(F.count(F.lit(1)).alias("n"))


def has_files(spark: SparkSession, root: str) -> bool:
    """Whether anything has landed; a missing root counts as empty. Stops at the first file."""
    if not path_exists(spark, root):
        return False
    files = each_file(spark, root)
    while files.hasNext():
        path = files.next().getPath().toString()
        if path.endswith((".json.gz", ".jsonl.gz")) and not re.search("/[_.]", path.removeprefix(root)):
            return True
    return False


def recorded_rows(spark: SparkSession, root: str, directories: Sequence[str] | None = None) -> int | None:
    """Rows of the given runs (default: all that landed) by their manifests; ``None`` where a run
    has none, so that its lines have to be counted."""
    runs = read_manifests(spark, root).where("not dry_run").select(
        F.explode("files").alias("path"), F.col("actual_record_count").alias("n")
    )
    if directories is None:
        directories = run_directories(spark, root)
    wanted = spark.createDataFrame([(d.strip("/"),) for d in directories], "path string")
    counted = wanted.join(runs, "path", "left").agg(F.sum("n"), F.count_if(F.col("n").isNull())).first()
    return None if counted[1] else int(counted[0] or 0)


def inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file: path, size, readable size, modification time. Contents are not read."""
    reader = spark.read.format("binaryFile")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path).select("path", "length", "modificationTime")
    return files.withColumn("size", text.human_size(F.col("length")))


def inventory_totals(files: DataFrame) -> DataFrame:
    """File count and total size of an inventory (one row)."""
    totals = files.agg(
        F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )
    return totals.withColumn("size", text.human_size(F.col("bytes")))


def write_manifest(spark: SparkSession, root: str, run_id: str, manifest: dict) -> None:
    """The summary row of a run; it replaces an earlier attempt's."""
    line = {"run_id": run_id} | {name: manifest[name] for name, _ in _MANIFEST if name != "run_id"}
    entry_log.append(spark, f"{root}/_manifests", [line], entry_log.newest_of("run_id"))


def write_file_list(files: DataFrame, root: str, run_id: str) -> None:
    """The landed files of a run, one row each."""
    files.select("path", "length").write.mode("overwrite").json(f"{root}/_files/run_id={run_id}")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """The newest manifest of every run."""
    return entry_log.latest(spark, f"{root}/_manifests", MANIFEST_SCHEMA, "run_id")


def read_file_lists(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """The landed files of one run, or of all."""
    if run_id is None:
        return read_json_log(spark, f"{root}/_files", FILE_SCHEMA)
    files = read_json_log(spark, f"{root}/_files/run_id={run_id}", "path string, length bigint")
    return files.select(F.lit(run_id).alias("run_id"), "path", "length")


def read_complete_runs(
    spark: SparkSession, root: str, *, row_id: bool = False, file_path: bool = False
) -> DataFrame:
    """Landed rows of the runs whose manifest says ``ok``.

    One scan of the root whose run partitions are pruned by a join with the manifests while the
    query runs: the driver handles no path of a run, and files of short or unfinished runs are not
    opened. Rows landed without a manifest (see :func:`append_history`) are not read.
    """
    if not entry_log.newest(spark, f"{root}/_manifests"):
        return empty_landing(spark)
    complete = read_manifests(spark, root).where("status = 'ok' and not dry_run and size(files) > 0")
    # A manifest names its run's directory, level by level: ``ingest_year=2024/...``.
    levels = contracts.names(contracts.LANDING_PARTITIONS)
    named = complete.select(F.explode("files").alias("path")).select(F.split("path", "/").alias("levels"))
    complete = named.select(*(F.split(F.get("levels", F.lit(i)), "=")[1].alias(n) for i, n in enumerate(levels))).distinct()
    landed = read_landed(spark, root, row_id=row_id, file_path=file_path)
    return landed.join(complete, levels, "left_semi").select(*landed.columns)


def read_mark(spark: SparkSession, root: str, slice_name: str = "") -> datetime | None:
    """The stored high-water mark of a slice, or ``None`` before the first complete run."""
    known = entry_log.lines(spark, entry_log.files(spark, f"{root}/_state"))
    newest = max((line["watermark"] for line in known if line["slice"] == slice_name), default=None)
    return datetime.fromisoformat(newest) if newest else None


def read_marks(spark: SparkSession, root: str) -> DataFrame:
    """The highest mark of every slice: slice, watermark, updated_by_run, updated_at."""
    return entry_log.latest(spark, f"{root}/_state", contracts.STATE_SCHEMA, "slice", by="watermark")


def append_mark(spark: SparkSession, root: str, mark_ms: int, run_id: str, slice_name: str = "") -> None:
    """Record an advance of the mark; earlier ones stay as history until a snapshot of the log, which
    keeps the newest of every slice."""
    mark = datetime.fromtimestamp(0, timezone.utc) + timedelta(milliseconds=mark_ms)
    line = {
        "slice": slice_name,
        "watermark": mark.isoformat(timespec="microseconds"),
        "updated_by_run": run_id,
        "updated_at": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
    }
    entry_log.append(spark, f"{root}/_state", [line], _highest)


def _highest(lines: list[dict]) -> list[dict]:
    """The line with the highest mark of every slice."""
    return entry_log.newest_of("slice")(sorted(lines, key=lambda line: line["watermark"]))
