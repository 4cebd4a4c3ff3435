"""Incremental extracts from a source table by a high-water mark."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.functions import time


def cold_start_mark(now: datetime, lookback_days: int = contracts.COLD_START_DAYS) -> datetime:
    """The lower bound of a first run, when no mark is stored."""
    return now - timedelta(days=lookback_days)


def newer_than(
    df: DataFrame, column: str, mark: datetime | None, overlap: timedelta = timedelta(0)
) -> Column:
    """Predicate ``column > mark`` with the mark cut to whole seconds; no mark takes everything.

    The column is compared as stored (epoch milliseconds, timestamp or zone-less UTC
    timestamp) so the predicate reaches the source. ``overlap`` moves the bound back for
    sources whose dates are coarser than their arrival; repeats are removed downstream.
    """
    if mark is None:
        return F.lit(True)
    bound = (mark.astimezone(timezone.utc) - overlap).replace(microsecond=0)
    kind = dict(df.dtypes)[column]
    if kind == "bigint":
        return F.col(column) > int(bound.timestamp()) * 1000
    if kind == "timestamp_ntz":
        return F.col(column) > F.lit(bound.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return F.col(column) > F.lit(bound)


def extract(
    df: DataFrame,
    marks: Mapping[str, datetime | None],
    overlap: timedelta = timedelta(0),
) -> DataFrame:
    """Rows past the mark of any listed column.

    One column is the usual creation mark; adding a modification column also fetches rows
    that changed after they were first delivered. A column without a mark takes everything.
    """
    wanted = F.lit(False)
    for column, mark in marks.items():
        wanted = wanted | newer_than(df, column, mark, overlap)
    return df.where(wanted)


def announced_rows(wanted: DataFrame) -> int | None:
    """The row count of an extract whose source states it without giving its rows: a whole Parquet or
    ORC table, by its file footers. ``None`` for any other, filtered ones included."""
    plan = wanted._jdf.queryExecution().optimizedPlan()
    while plan.getClass().getSimpleName() == "Project":
        plan = plan.child()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = plan.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return None
    kind = relation.fileFormat().getClass().getSimpleName()
    return wanted.count() if kind in ("ParquetFileFormat", "OrcFileFormat") else None


def as_epoch_ms(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    return F.col(column) if kind == "bigint" else time.to_epoch_ms(F.col(column))


def high_water(df: DataFrame, column: str, previous: datetime | None) -> Column:
    """Aggregate: the newest mark of an extract in epoch ms, never before the previous one."""
    newest = F.max(as_epoch_ms(df, column))
    if previous is None:
        return newest
    return F.greatest(F.lit(int(previous.astimezone(timezone.utc).timestamp() * 1000)), newest)


def partition_marks(df: DataFrame, column: str, partition: Column) -> DataFrame:
    """High-water mark and row count per partition, for state kept per slice of a source."""
    newest = F.max(as_epoch_ms(df, column)).alias("mark_ms")
    return df.groupBy(partition.alias("slice")).agg(newest, F.count(F.lit(1)).alias("n_rows"))


def past_partition_marks(
    df: DataFrame, column: str, partition: Column, marks: DataFrame
) -> DataFrame:
    """Rows past their own slice's mark; slices without a mark are taken whole."""
    tagged = df.withColumn("slice", partition).join(
        marks.select("slice", F.col("mark_ms").alias("_mark")), "slice", "left"
    )
    fresh = F.col("_mark").isNull() | (as_epoch_ms(df, column) > F.col("_mark"))
    return tagged.where(fresh).drop("_mark", "slice")
