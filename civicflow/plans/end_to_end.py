"""Ingest, transform and load in order; a stage that fails keeps the later ones from running."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators.quality import QualityGateError
from civicflow.plans import holding
from civicflow.plans.ingest import ingest
from civicflow.plans.load import load_star
from civicflow.plans.transform import REQUESTS, accepted_rows, quarantined_rows, transform
from civicflow.sources import landing, snapshots


class ShortReadError(RuntimeError):
    """The source delivered fewer rows than it announced."""


def run(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    *,
    run_id: str,
    run_at: datetime,
    incremental: bool = False,
    park_failures: bool = False,
    transform_options: dict | None = None,
    load_options: dict | None = None,
    **ingest_options,
) -> dict:
    """One full run below ``root`` (``raw/``, ``processed/``, ``warehouse/``).

    By default the transform covers everything that ever landed. ``incremental`` limits it to
    the complete runs that no committed load holds yet: this one, and earlier ones whose
    transform or load failed. The mark has passed those, so nothing else would read them again.
    Runs that came up short are never among them. A run without new rows changes nothing.

    With ``park_failures`` (and ``incremental``) every waiting run is judged and loaded alone, in
    the order of landing. One that fails a hard check is parked with its reason and holds up no
    other; later calls leave it out until :func:`civicflow.plans.holding.release` lets it in again.
    The result names the runs that this call parked.

    Rows that an incremental run sets apart are committed with its load, see
    :func:`civicflow.plans.load.read_quarantine`.
    """
    manifest = ingest(spark, source, f"{root}/raw", run_id=run_id, run_at=run_at, **ingest_options)
    if manifest["status"] != "ok":
        raise ShortReadError(
            f"run {run_id}: expected {manifest['expected_record_count']} rows, "
            f"landed {manifest['actual_record_count']}"
        )
    waiting = unloaded_runs(spark, root)
    result = {"manifest": manifest, "summary": None, "version": None, "parked": []}
    if not incremental:
        return result | _carry(spark, root, run_id, run_at, None, sorted(waiting), transform_options, load_options)
    if not park_failures:
        return result | _carry(spark, root, run_id, run_at, waiting, sorted(waiting), transform_options, load_options)

    held = {row["run_id"] for row in holding.parked_runs(spark, root).collect()}
    for waiting_id, path in sorted(waiting.items(), key=lambda item: item[1]):
        if waiting_id in held:
            continue
        try:
            one = {waiting_id: path}
            done = _carry(spark, root, waiting_id, run_at, one, [waiting_id], transform_options, load_options)
        except QualityGateError as failure:
            holding.park(spark, root, waiting_id, str(failure))
            result["parked"].append(waiting_id)
        else:
            result |= {key: value for key, value in done.items() if value is not None}
    return result


def _carry(
    spark: SparkSession,
    root: str,
    batch_id: str,
    run_at: datetime,
    only: dict[str, str] | None,
    runs: list[str],
    transform_options: dict | None,
    load_options: dict | None,
) -> dict:
    """Transform and load landed runs as one batch: those of ``only``, or all there are."""
    nothing = {"summary": None, "version": None}
    if only is not None and not only:
        return nothing
    directories = None if only is None else sorted(only.values())
    options = transform_options or {}
    summary = transform(spark, f"{root}/raw", f"{root}/processed", batch_id=batch_id, directories=directories, **options)
    if summary is None:
        return nothing
    path = snapshots.table_path(spark, f"{root}/processed", REQUESTS)
    # A transform of everything has all such rows in its published version.
    apart = quarantined_rows(spark, path) if only is not None and options.get("quarantine") else None
    version = load_star(
        spark, accepted_rows(spark, path), f"{root}/warehouse", batch_id=batch_id, loaded_at=run_at, runs=runs,
        quarantined=apart, **(load_options or {}),
    )
    return {"summary": summary, "version": version}


def unloaded_runs(spark: SparkSession, root: str) -> dict[str, str]:
    """Complete runs with rows that no committed load names, with their directories.

    Normally that is the run just landed; after failures one more for each.
    """
    loaded = snapshots.commits(spark, f"{root}/warehouse").select(F.explode("runs").alias("run_id"))
    complete = landing.read_manifests(spark, f"{root}/raw").where(
        "status = 'ok' and not dry_run and actual_record_count > 0"
    )
    waiting = complete.join(loaded, "run_id", "left_anti").select("run_id", F.explode("files").alias("path"))
    return {row["run_id"]: row["path"] for row in waiting.collect()}
