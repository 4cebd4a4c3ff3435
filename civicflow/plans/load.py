"""Load a clean batch into the star schema as a new published version.

Every table is a list of parts, as the commit log names them. A load writes new parts and says which
ones they replace; what it costs follows the batch and the parts that hold its cases. Those are found
by key range and key sketch, then by the keys themselves, of which none are exchanged.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.operators import dimensions, facts, key_sketch
from civicflow.session import PARTITION_BYTES, configure, sized_shuffles
from civicflow.sources import snapshots, tables
from civicflow.sources.snapshots import Part, State

# Rows in memory against the Parquet files they come from.
EXPANSION = 16.0
# A part is sorted by one task; this much in files is some hundred MB there.
PART_BYTES = PARTITION_BYTES // 8
# Parts below half the target size are small; so many of a table become one.
SMALL_PARTS = 8

DIMENSIONS = {
    "dim_agency": dimensions.new_agencies,
    "dim_service_type": dimensions.new_service_types,
    "dim_neighborhood": dimensions.new_neighborhoods,
    "dim_date": dimensions.new_dates,
}
KEYED = {facts.FACT: "object_id"}
QUARANTINE = "quarantined_requests"
STAGED, SKETCHES = "_staged", "_sketches"


class BatchKeyError(ValueError):
    """A batch that the fact's key or its creation time forbids."""


def load_star(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    *,
    batch_id: str,
    loaded_at: datetime | None = None,
    keep_versions: int | None = None,
    runs: Sequence[str] = (),
    quarantined: DataFrame | None = None,
    part_bytes: int = PART_BYTES,
) -> int:
    """Merge ``batch`` (clean cases, keys unique) and return the version that holds it.

    ``batch`` should be a stored table: the dimensions and the fact each read the columns
    they need. A ``batch_id`` that was already committed is not loaded again. ``runs`` are
    the landed runs the batch comes from; the commit names them. ``quarantined`` rows are appended
    to the table of that name under their ``batch_id`` by the same commit; no load replaces them.

    A load writes what it changes: new members of each dimension, and those parts of the fact
    that hold a case of the batch. A part is a range of months and, of a large month, of keys, of
    about ``part_bytes``; other parts are neither read whole nor written. Small parts of a table
    become one when there are SMALL_PARTS of them. Repeated or missing keys and missing creation
    times are refused before anything is committed, and so is a version that another load commits
    first. With ``keep_versions`` files that no kept version shows are deleted after the commit.
    """
    configure(spark)
    held = snapshots.version_of(spark, root, batch_id)
    if held is not None:
        return held
    before = snapshots.state(spark, root)
    version = before.version + 1
    folder = snapshots.new_folder(version)
    try:
        with sized_shuffles(batch, EXPANSION):
            members, compacted = _write_dimensions(spark, batch, root, before, folder)
            added, removed = _write_facts(spark, batch, root, before, members, folder, loaded_at, part_bytes)
            if quarantined is not None:
                added += _write_quarantine(spark, quarantined, root, folder, batch_id)
        tables.delete_path(spark, f"{root}/{folder}/{STAGED}")
    except Exception:
        tables.delete_path(spark, f"{root}/{folder}")
        raise
    added += [part for parts in members.values() for part in parts if part.path not in before.parts]
    try:
        snapshots.commit(spark, root, version, batch_id, runs, added, [*removed, *compacted])
    except snapshots.StaleVersionError:
        # Only then is it certain that the log does not name the folder.
        tables.delete_path(spark, f"{root}/{folder}")
        raise
    if keep_versions is not None:
        expire(spark, root, keep_versions)
    return version


def _read_parts(spark: SparkSession, root: str, table: str, parts: Sequence[Part]) -> DataFrame:
    columns = contracts.ddl(contracts.STAR_TABLES[table])
    if not parts:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(*(f"{root}/{part.path}" for part in parts))


def _written(spark: SparkSession, root: str, table: str, path: str) -> list[Part]:
    """The files of a table written at ``path``, as parts; files without rows are none."""
    file, key = F.col("_metadata"), KEYED.get(table)
    limits = [F.min(key).alias("low"), F.max(key).alias("high")] if key else []
    found = spark.read.schema(contracts.ddl(contracts.STAR_TABLES[table])).parquet(f"{root}/{path}")
    files = found.groupBy(file["file_name"].alias("name"), file["file_size"].alias("bytes"))
    parts = [
        Part(table, f"{path}/{row['name']}", row["rows"], row["bytes"], *((row["low"], row["high"]) if key else ()))
        for row in files.agg(F.count(F.lit(1)).alias("rows"), *limits).collect()
    ]
    return sorted(parts, key=lambda part: part.path)


def _small(parts: Sequence[Part], part_bytes: int) -> list[Part]:
    """Parts to be merged: all small ones once there are enough of them."""
    small = [part for part in parts if part.bytes < part_bytes / 2]
    return small if len(small) >= SMALL_PARTS else []


def _write_dimensions(
    spark: SparkSession, batch: DataFrame, root: str, before: State, folder: str
) -> tuple[dict[str, list[Part]], list[str]]:
    """All parts of each dimension once the batch's members are in, and the paths of those that
    were merged. The dimensions are written at the same time; none is large and none needs another."""

    def write(table: str, build: Callable) -> tuple[str, list[Part], list[str]]:
        held = before.of(table)
        existing = _read_parts(spark, root, table, held) if held else None
        seen = Observation()
        build(batch, existing).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{root}/{folder}/{table}")
        fresh = _written(spark, root, table, f"{folder}/{table}") if seen.get["rows"] else []
        merged = _small([*held, *fresh], PARTITION_BYTES) if fresh else []
        if not merged:
            return table, [*held, *fresh], []
        together = _read_parts(spark, root, table, merged)
        _sized(together, sum(part.bytes for part in merged)).write.parquet(f"{root}/{folder}/{table}-merged")
        kept = [part for part in [*held, *fresh] if part not in merged]
        return table, [*kept, *_written(spark, root, table, f"{folder}/{table}-merged")], [p.path for p in merged if p in held]

    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(lambda item: write(*item)), DIMENSIONS.items()))
    return {table: parts for table, parts, _ in found}, [path for _, _, paths in found for path in paths]


def _sized(rows: DataFrame, size: int, *order: str, part_bytes: int = PARTITION_BYTES) -> DataFrame:
    """``rows`` dealt to files of about ``part_bytes``, by ranges of ``order`` if there is any."""
    files = math.ceil(size / part_bytes)
    if files <= 1:
        return rows.repartition(1)
    return rows.repartitionByRange(files, *order) if order else rows.repartition(files)


def _write_facts(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    before: State,
    members: dict[str, list[Part]],
    folder: str,
    loaded_at: datetime | None,
    part_bytes: int,
) -> tuple[list[Part], list[str]]:
    """New parts of the fact, and the paths of those they replace."""
    stamp = F.lit(loaded_at or datetime.now(timezone.utc))
    whole = [_read_parts(spark, root, t, members[t]) for t in ("dim_agency", "dim_service_type", "dim_neighborhood")]
    staging = f"{root}/{folder}/{STAGED}"
    facts.stage_facts(batch, *whole, stamp).write.parquet(staging)
    staged = spark.read.schema(contracts.ddl(contracts.STAR_TABLES[facts.FACT])).parquet(staging)
    rows, low, high = _checked(staged)
    if not rows:
        return [], []

    held = before.of(facts.FACT)
    touched = touched_parts(spark, root, [p for p in held if p.high >= low and p.low <= high], staged, rows)
    replaced = touched + [part for part in _small(held, part_bytes) if part not in touched]
    merged = facts.merge_facts(_read_parts(spark, root, facts.FACT, replaced) if replaced else None, staged)
    size = tables.stored_bytes(spark, staging) + sum(part.bytes for part in replaced)
    month = facts.created_month(F.col("created_at"))
    ranged = _sized(merged.withColumn(facts.MONTH, month), size, facts.MONTH, "object_id", part_bytes=part_bytes)
    path = f"{folder}/{facts.FACT}"
    ranged.sortWithinPartitions(facts.MONTH, "object_id").drop(facts.MONTH).write.parquet(f"{root}/{path}")
    keys = rows + sum(part.rows for part in replaced)
    buckets = key_sketch.buckets_for(math.ceil(keys / max(1, math.ceil(size / part_bytes))))
    with ThreadPoolExecutor(1) as pool:
        sketched = pool.submit(inheritable_thread_target(spark)(_write_sketches), spark, root, folder, buckets, keys)
        added = _written(spark, root, facts.FACT, path)
        sketched.result()
    return [replace(part, buckets=buckets) for part in added], [part.path for part in replaced]


def _checked(staged: DataFrame) -> tuple[int, int, int]:
    """Rows, smallest and largest key of a staged batch whose keys are unique and whose columns are
    there."""
    rows, keys, no_key, no_time, low, high = staged.agg(
        F.count(F.lit(1)), F.count_distinct("object_id"), F.count_if(F.col("object_id").isNull()),
        F.count_if(F.col("created_at").isNull()), F.min("object_id"), F.max("object_id"),
    ).first()
    problems = [
        f"{number} rows {text}"
        for number, text in (
            (rows - no_key - keys, "repeat a key"),
            (no_key, "have no key"),
            (no_time, "have no creation time"),
        )
        if number
    ]
    if problems:
        raise BatchKeyError("; ".join(problems))
    return rows, low, high


def known_cases(known: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``known`` (key and others) whose key is one of ``keys``: the stored keys stay where
    they are read, as long as the batch is small enough to be sent to them."""
    return known.join(keys, "key", "left_semi")


def touched_parts(
    spark: SparkSession, root: str, parts: Sequence[Part], staged: DataFrame, rows: int
) -> list[Part]:
    """Those of ``parts`` that hold a key of ``staged``, which has so many ``rows``.

    A probe of the sketches looks at each key in each part. It comes first where that is less than
    the keys of the parts themselves, which are read in the parts that may hold one.
    """
    keys = staged.select(F.col("object_id").alias("key"))
    by_path = {part.path: part for part in parts}
    if by_path and rows * len(by_path) <= sum(part.rows for part in parts):
        folders = {path.rsplit("/", 2)[0] for path in by_path}
        sketch = spark.read.schema("part string, buckets int, bucket int, bits binary").parquet(
            *(f"{root}/{folder}/{SKETCHES}" for folder in sorted(folders))
        )
        found = key_sketch.parts_that_may_hold(sketch, keys, sorted({part.buckets for part in parts})).collect()
        by_path = {row["part"]: by_path[row["part"]] for row in found if row["part"] in by_path}
    if not by_path:
        return []
    stored = _read_parts(spark, root, facts.FACT, list(by_path.values()))
    named = stored.select(F.col("object_id").alias("key"), F.col("_metadata.file_name").alias("file"))
    names = {row["file"] for row in known_cases(named, keys).select("file").distinct().collect()}
    return [part for path, part in sorted(by_path.items()) if path.rsplit("/", 1)[1] in names]


def _write_sketches(spark: SparkSession, root: str, folder: str, buckets: int, rows: int) -> None:
    """Sketches of the keys of the parts that were just written, so many ``rows``, beside them."""
    stored = spark.read.schema("object_id bigint").parquet(f"{root}/{folder}/{facts.FACT}")
    keys = stored.select(F.col("_metadata.file_name").alias("part"), F.col("object_id").alias("key"))
    sketch = key_sketch.sketches(keys, buckets, rows)
    sketch = sketch.withColumn("part", F.concat(F.lit(f"{folder}/{facts.FACT}/"), "part"))
    sketch.sortWithinPartitions("bucket").write.parquet(f"{root}/{folder}/{SKETCHES}")


def _write_quarantine(
    spark: SparkSession, quarantined: DataFrame, root: str, folder: str, batch_id: str
) -> list[Part]:
    """The batch's rows that were set apart, as a part of their own; none if there are none."""
    path = f"{folder}/{QUARANTINE}"
    quarantined.withColumn("batch_id", F.lit(batch_id)).write.parquet(f"{root}/{path}")
    rows = spark.read.parquet(f"{root}/{path}").count()
    return [Part(QUARANTINE, path, rows, tables.stored_bytes(spark, f"{root}/{path}"))] if rows else []


def read_quarantine(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows that committed batches set apart, with ``problems`` and their ``batch_id``; ``None``
    while there are none."""
    parts = snapshots.state(spark, root).of(QUARANTINE)
    if not parts:
        return None
    return spark.read.option("mergeSchema", True).parquet(*(f"{root}/{part.path}" for part in parts))


def read_table(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A star table of the given (default: newest) version."""
    return _read_parts(spark, root, table, snapshots.state(spark, root, version).of(table))


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete what none of the newest ``keep`` versions shows."""
    return snapshots.expire(spark, root, keep)


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the newest version; the log is read once."""
    state = snapshots.state(spark, root)
    return {table: _read_parts(spark, root, table, state.of(table)) for table in contracts.STAR_TABLES}


def load_report(spark: SparkSession, root: str, batch: DataFrame, version: int) -> DataFrame:
    """Per table: rows of the batch that attempted an upsert, and rows the version gained."""
    attempted = facts.load_counts(batch).select(
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(table).alias("table_name"), F.col(count).alias("attempted"))
                    for table, count in contracts.LOAD_COUNTS.items()
                )
            )
        ).alias("r")
    )

    def rows(table: str, at: int) -> int:
        return sum(part.rows for part in snapshots.state(spark, root, at).of(table))

    inserted = F.lit(None).cast("long")
    for table in contracts.LOAD_COUNTS:
        gained = rows(table, version) - rows(table, version - 1)
        inserted = F.when(F.col("table_name") == table, F.lit(gained).cast("long")).otherwise(inserted)
    return attempted.select("r.*").withColumn("inserted", inserted)
