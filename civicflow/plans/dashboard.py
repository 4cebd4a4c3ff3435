"""Everything the dashboard shows, as DataFrames over a loaded star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.functions import text
from civicflow import contracts
from civicflow.operators import distribution, metrics


def headline(star: dict[str, DataFrame]) -> DataFrame:
    """The four figures on top of the dashboard as they are shown (one row)."""
    fact = star["fact_service_request"]
    volume = metrics.volume_figures(fact, star["dim_agency"])
    volume = volume.select(F.struct("total_requests", "agencies").alias("volume")).scalar()
    median = F.col("median_hours")
    stats = distribution.resolution_stats(metrics.resolution_hours(fact)).withColumn("volume", volume)
    return stats.select(
        F.format_number("volume.total_requests", 0).alias("total_requests"),
        F.col("volume.agencies").alias("agencies"),
        text.percent_text(F.col("zero_hour_rate")).alias("same_call_share"),
        F.when(median.isNull(), "N/A")
        .otherwise(F.format_string("%.1f hrs", F.bround(median, 1)))
        .alias("median_time"),
    )


def dashboard(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    fact = star["fact_service_request"]
    hours = metrics.resolution_hours(fact)
    longer = distribution.value_counts(hours).where(F.col(distribution.VALUE) > 0)
    return {
        "headline": headline(star),
        "total_requests": metrics.total_requests(fact),
        "agencies_represented": metrics.agencies_represented(fact, star["dim_agency"]),
        "requests_by_agency": metrics.by_agency(fact, star["dim_agency"]),
        "requests_by_day": metrics.by_day(fact, star["dim_date"]),
        "requests_by_neighborhood": metrics.by_neighborhood(fact, star["dim_neighborhood"]),
        "resolution_population": hours,
        "resolution_stats": distribution.resolution_stats(hours),
        "resolution_histogram": distribution.histogram(longer),
        "map_points": metrics.map_points(fact, contracts.MAP_POINT_LIMIT),
    }
