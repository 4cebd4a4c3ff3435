"""Landed rows to published clean cases: write once, check what was written, then publish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.operators import quality
from civicflow.operators.clean import clean_requests
from civicflow.session import configure, sized_shuffles
from civicflow.sources import landing, snapshots, tables

# Rows in memory against the gzip JSON, or the staged Parquet, they come from.
EXPANSION = 10.0

REQUESTS = "requests"
ACCEPTED = "accepted"
QUARANTINED = "quarantined"


def stage_clean(raw: DataFrame, path: str, row_id: str | None = None) -> DataFrame:
    """Clean ``raw`` and write it in one pass, rows with row-level problems set apart.

    Both kinds go to directories of the same write, so the deduplication runs once. Returns
    what was written, read under its own schema, so an empty batch is an empty table.
    """
    marked = clean_requests(raw, row_id=row_id).withColumn("problems", quality.row_problems())
    disposition = F.when(F.size("problems") > 0, QUARANTINED).otherwise(ACCEPTED)
    staged = marked.withColumn("disposition", disposition)
    with sized_shuffles(raw, EXPANSION):
        staged.write.mode("overwrite").partitionBy("disposition").parquet(path)
    return raw.sparkSession.read.schema(staged.schema).parquet(path)


def rate_checks(max_corrupt: float, max_quarantined: float) -> list[quality.Check]:
    """Checks over all staged rows, those set apart included: a delivery that is mostly broken must
    not pass because its broken rows are left out."""
    corrupt = F.col(contracts.CORRUPT_COLUMN).isNotNull()
    apart = F.col("disposition") == QUARANTINED
    return [
        quality.share_limit("corrupt_share", corrupt, max_corrupt, "do not fit the declared schema"),
        quality.share_limit("quarantine_share", apart, max_quarantined, "break a row-level check"),
    ]


def judge(
    staged: DataFrame,
    checks: Sequence[quality.Check],
    quarantine: bool,
    max_corrupt: float,
    max_quarantined: float,
) -> quality.GateResult:
    """The gate's verdict on a staged batch: ``checks`` over the rows to be published, and with
    ``quarantine`` the rates over all."""
    if not quarantine:
        return quality.gate_result(quality.quality_report(staged, checks))
    accepted = quality.quality_report(staged.where(F.col("disposition") == ACCEPTED), checks)
    rates = quality.quality_report(staged, rate_checks(max_corrupt, max_quarantined))
    return quality.gate_result(accepted.unionAll(rates.where("check_name <> 'row_count'")))



def summary_measures(raw_rows: Column) -> list[quality.Check]:
    outside = ~F.col("has_valid_coordinates") & F.col("Latitude").isNotNull()
    return [
        quality.info("raw_rows", raw_rows),
        quality.info("internal_flagged", F.count_if(F.col("is_likely_internal"))),
        quality.info("invalid_coordinates", F.count_if(outside)),
    ]


def transform(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    *,
    batch_id: str,
    checks: Sequence[quality.Check] | None = None,
    quarantine: bool = False,
    directories: Sequence[str] | None = None,
    preview_path: str | None = None,
    preview_rows: int = contracts.PREVIEW_ROWS,
    keep_versions: int | None = None,
    max_corrupt: float = contracts.MAX_CORRUPT_RATE,
    max_quarantined: float = contracts.MAX_QUARANTINE_RATE,
) -> dict | None:
    """One transform run; returns its summary, or ``None`` when there were no rows.

    ``directories`` (as a manifest lists them) restricts the run to newly landed data; the
    default reads the whole zone. The published table holds what the run read: everything by
    default, and with ``directories`` the cases of these runs only, which is what an incremental
    load merges. With ``keep_versions`` older published versions are deleted after the commit.

    The raw rows are parsed once, by the write; gate and summary are one aggregate over the
    written columns, and raw counts come from the runs' manifests. A hard failure raises :class:`quality.QualityGateError`
    before the version is committed, so readers keep the previous one. With
    ``quarantine`` the rows that break a row-level check are left out of the published
    table instead of failing the batch, as long as their share of all rows is at most
    ``max_quarantined`` and that of damaged lines at most ``max_corrupt``. A run without rows
    publishes nothing.
    """
    configure(spark)
    paths = None if directories is None else [f"{raw_root}/{d}" for d in directories]
    if not any(landing.has_files(spark, p) for p in (paths if paths is not None else [raw_root])):
        return None
    before = snapshots.state(spark, out_root)
    version = before.version + 1
    folder = snapshots.new_folder(version)
    path = f"{out_root}/{folder}/{REQUESTS}"
    staged = stage_clean(landing.read_landed(spark, raw_root, row_id=True, paths=paths), path, landing.ROW_ID)

    # The runs' manifests know how many rows they landed; only runs without one are read again.
    recorded = landing.recorded_rows(spark, raw_root, directories)
    raw_rows = F.lit(recorded) if recorded is not None else landing.count_lines(spark, raw_root, paths).scalar()
    all_checks = [
        *(checks if checks is not None else [*quality.default_checks(), quality.corrupt_rate()]),
        *summary_measures(raw_rows),
        quality.info("staged_rows", staged.agg(F.count(F.lit(1))).scalar()),
    ]
    with sized_shuffles(staged, EXPANSION):
        result = judge(staged, all_checks, quarantine, max_corrupt, max_quarantined)
    if not result.measures.get("staged_rows", 1):
        tables.delete_path(spark, path)
        return None
    quality.require_pass(result)
    part = snapshots.Part(REQUESTS, f"{folder}/{REQUESTS}", int(result.measures["staged_rows"]), tables.stored_bytes(spark, path))
    snapshots.commit(spark, out_root, version, batch_id, added=[part], removed=[p.path for p in before.of(REQUESTS)])
    if keep_versions is not None:
        snapshots.expire(spark, out_root, keep_versions)

    clean = read_clean(spark, out_root)
    if preview_path is not None:
        tables.write_preview(clean, preview_path, preview_rows)
    figures = {k: int(v) for k, v in result.measures.items() if k in _SUMMARY_FIGURES}
    return {
        "raw_rows": figures["raw_rows"],
        "clean_rows": result.row_count,
        "duplicates_removed": figures["raw_rows"] - figures["staged_rows"],
        "quarantined_rows": figures["staged_rows"] - result.row_count,
        "internal_flagged": figures["internal_flagged"],
        "invalid_coordinates": figures["invalid_coordinates"],
        "quality_gate": "passed",
        "quality_warnings": len(result.warnings),
        "warnings": result.warnings,
    }


_SUMMARY_FIGURES = {"raw_rows", "staged_rows", "internal_flagged", "invalid_coordinates"}


def read_clean(spark: SparkSession, out_root: str) -> DataFrame:
    """The published clean cases."""
    return accepted_rows(spark, snapshots.table_path(spark, out_root, REQUESTS))


def accepted_rows(spark: SparkSession, path: str) -> DataFrame:
    staged = spark.read.parquet(path).where(F.col("disposition") == ACCEPTED)
    return staged.select(*tables.PROCESSED_COLUMNS)


def quarantined_rows(spark: SparkSession, path: str) -> DataFrame:
    staged = spark.read.parquet(path).where(F.col("disposition") == QUARANTINED)
    return staged.drop("disposition")
