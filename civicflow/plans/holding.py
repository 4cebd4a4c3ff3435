"""Runs that are held back: a log of what was parked, why, and what was released again."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from civicflow.sources import entry_log

HOLD_SCHEMA = "run_id string, parked boolean, reason string, at timestamp"


def _append(spark: SparkSession, root: str, run_id: str, parked: bool, reason: str | None) -> None:
    line = {"run_id": run_id, "parked": parked, "reason": reason, "at": datetime.now(timezone.utc).isoformat()}
    entry_log.append(spark, f"{root}/_parked", [line], entry_log.newest_of("run_id"))


def park(spark: SparkSession, root: str, run_id: str, reason: str) -> None:
    """Keep a run out of the loads until it is released."""
    _append(spark, root, run_id, True, reason)


def release(spark: SparkSession, root: str, run_id: str) -> None:
    """Let the next run try again."""
    _append(spark, root, run_id, False, None)


def parked_runs(spark: SparkSession, root: str) -> DataFrame:
    """The runs that are parked now: run_id, reason, at. The newest line of a run counts."""
    found = entry_log.latest(spark, f"{root}/_parked", HOLD_SCHEMA, "run_id")
    return found.where("parked").select("run_id", "reason", "at")
