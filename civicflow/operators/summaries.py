"""Counts over a transform run: what came in, what was kept, what was flagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.quality import distinct_keys


def flag_counts(clean: DataFrame) -> DataFrame:
    """One row: clean rows, internal rows and rows with coordinates outside the area."""
    outside = ~F.col("has_valid_coordinates") & F.col("Latitude").isNotNull()
    return clean.agg(
        F.count(F.lit(1)).alias("clean_rows"),
        F.count_if(F.col("is_likely_internal")).alias("internal_flagged"),
        F.count_if(outside).alias("invalid_coordinates"),
    )


def transform_summary(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """One row of run totals; duplicates are the raw rows that did not survive."""
    raw_rows = raw.agg(F.count(F.lit(1))).scalar()
    return flag_counts(clean).select(
        raw_rows.alias("raw_rows"),
        "clean_rows",
        (raw_rows - F.col("clean_rows")).alias("duplicates_removed"),
        "internal_flagged",
        "invalid_coordinates",
    )


def duplicate_count(df: DataFrame, key: str = "OBJECTID") -> DataFrame:
    """One row: rows, distinct keys (NULL is one) and surplus rows, in a single pass."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), distinct_keys(F.col(key)).alias("n_keys"))
    return counted.withColumn("n_surplus", F.col("n_rows") - F.col("n_keys"))


def latest_rows(df: DataFrame, columns: list[str], limit: int, newest: str = "created_at") -> DataFrame:
    """The newest ``limit`` rows; equal times are ordered by case key."""
    order = [F.col(newest).desc_nulls_last(), F.col("OBJECTID").asc_nulls_last()]
    return df.orderBy(*order).limit(limit).select(*columns)
