"""Comparisons of a delivery with earlier ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_ranges(df: DataFrame, delivery: Sequence[str], key: str = "OBJECTID") -> DataFrame:
    """Key range of every delivery next to that of the one before.

    ``restarted`` marks a delivery whose keys all lie below the previous range, ``gap``
    the number of unused keys after it: the signs of reissued keys.
    """
    ranges = df.groupBy(*delivery).agg(
        F.min(key).alias("min_key"), F.max(key).alias("max_key"), F.count(F.lit(1)).alias("n_rows")
    )
    # One row per delivery goes through this window.
    earlier = Window.orderBy(*delivery)
    before_min, before_max = F.lag("min_key").over(earlier), F.lag("max_key").over(earlier)
    return ranges.withColumns(
        {
            "restarted": F.coalesce(F.col("max_key") < before_min, F.lit(False)),
            "gap": F.greatest(F.lit(0), F.col("min_key") - before_max - 1),
        }
    )


def volume_anomalies(
    history: DataFrame, order: str, count: str, past: int = 7, limit: float = 3.0
) -> DataFrame:
    """Deliveries whose row count is far from the mean of up to ``past`` earlier ones.

    ``history`` holds one row per delivery. ``score`` is the distance in standard
    deviations; it is NULL with fewer than two earlier deliveries or without variation.
    """
    earlier = Window.orderBy(order).rowsBetween(-past, -1)
    mean, spread = F.avg(count).over(earlier), F.stddev_samp(count).over(earlier)
    score = F.try_divide(F.col(count) - mean, spread)
    scored = history.withColumn("expected_rows", mean).withColumn("score", score)
    return scored.withColumn("unusual", F.coalesce(F.abs("score") > limit, F.lit(False)))


def rows_per_slice(df: DataFrame, slice_of: Column, name: str) -> DataFrame:
    return df.groupBy(slice_of.alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))
