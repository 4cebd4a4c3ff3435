"""Dashboard metrics over the star schema.

Facts are aggregated by their integer foreign key first and the few groups are joined to
the dimension afterwards: the large side is combined map-side, never joined, and no
dimension has to fit anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.functions import numbers


def public_facts(fact: DataFrame) -> DataFrame:
    """Facts that are not internal notices; a missing flag counts as public."""
    return fact.where(~numbers.false_if_null(F.col("is_likely_internal")))


def total_requests(fact: DataFrame) -> DataFrame:
    return public_facts(fact).agg(F.count(F.lit(1)).alias("total_requests"))


def _volume(grouped) -> DataFrame:
    """Count, closed count, and average hours of a grouping."""
    return grouped.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("is_closed")).alias("closed_requests"),
        numbers.rounded_average(F.col("resolution_hours")).alias("avg_resolution_hours"),
    )


def by_agency(fact: DataFrame, agency: DataFrame) -> DataFrame:
    """Volume, closed volume and average hours per agency, largest first."""
    per_key = _volume(public_facts(fact).groupBy("agency_key"))
    named = per_key.join(agency.select("agency_key", "agency_name"), "agency_key")
    return named.select(
        "agency_name", "total_requests", "closed_requests", "avg_resolution_hours"
    ).orderBy(F.desc("total_requests"), "agency_name")


def agencies_represented(fact: DataFrame, agency: DataFrame) -> DataFrame:
    """Number of agencies with at least one public case."""
    present = public_facts(fact).select("agency_key").distinct()
    return present.join(agency, "agency_key").agg(F.count(F.lit(1)).alias("agencies"))


def volume_figures(fact: DataFrame, agency: DataFrame) -> DataFrame:
    """One row: public cases, and agencies with at least one; one scan of the facts for both."""
    per_key = public_facts(fact).groupBy("agency_key").agg(F.count(F.lit(1)).alias("n"))
    known = agency.select("agency_key", F.lit(1).alias("known"))
    return per_key.join(known, "agency_key", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_requests"), F.count("known").alias("agencies")
    )


def by_day(fact: DataFrame, date: DataFrame) -> DataFrame:
    """Cases per creation day, in date order."""
    per_key = (
        public_facts(fact)
        .groupBy(F.col("created_date_key").alias("date_key"))
        .agg(F.count(F.lit(1)).alias("request_count"))
    )
    days = per_key.join(date.select("date_key", "full_date"), "date_key")
    return days.select("full_date", "request_count").orderBy("full_date")


def by_neighborhood(
    fact: DataFrame, neighborhood: DataFrame, limit: int = contracts.TOP_NEIGHBORHOODS
) -> DataFrame:
    """The ``limit`` neighborhoods with most cases."""
    per_key = _volume(public_facts(fact).groupBy("neighborhood_key"))
    named = per_key.join(
        neighborhood.select("neighborhood_key", "neighborhood_name"), "neighborhood_key"
    )
    return (
        named.select("neighborhood_name", "total_requests", "avg_resolution_hours")
        .orderBy(F.desc("total_requests"), "neighborhood_name")
        .limit(limit)
    )


def map_points(fact: DataFrame, limit: int | None = None) -> DataFrame:
    """Located public cases with map-ready column names; with ``limit`` the lowest keys only."""
    located = public_facts(fact).where(F.col("has_valid_coordinates"))
    if limit is not None:
        located = located.orderBy("object_id").limit(limit)
    points = located.select("latitude", "longitude", "case_status", "incident_address")
    return points.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})


def resolution_hours(fact: DataFrame) -> DataFrame:
    """Hours of every closed public case."""
    closed = public_facts(fact).where(F.col("is_closed") & F.col("resolution_hours").isNotNull())
    return closed.select("resolution_hours")


def slowest(fact: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """Members of a dimension by average hours, slowest first; members without any come last."""
    named = _volume(public_facts(fact).groupBy(key)).join(dimension.select(key, name), key)
    return named.select(name, "closed_requests", "avg_resolution_hours").orderBy(
        F.col("avg_resolution_hours").desc_nulls_last(), name
    )


def by_year(fact: DataFrame, date: DataFrame) -> DataFrame:
    """Average hours per creation year, with the change against the year before."""
    # Sum and count per day key shrink the facts before the join; years follow from them.
    hours = F.col("resolution_hours")
    per_day = (
        public_facts(fact)
        .groupBy(F.col("created_date_key").alias("date_key"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(hours.cast("decimal(20,2)")).alias("s"),
            F.count(hours).alias("k"),
        )
    )
    average = (F.sum("s").cast("double") / F.nullif(F.sum("k"), F.lit(0))).alias("avg_resolution_hours")
    per_year = (
        per_day.join(date.select("date_key", "year"), "date_key")
        .groupBy("year")
        .agg(F.sum("n").alias("total_requests"), average)
    )
    # One row per calendar year goes through this window.
    before = F.lag("avg_resolution_hours").over(Window.orderBy("year"))
    return per_year.select(
        "year",
        "total_requests",
        F.round("avg_resolution_hours", 1).alias("avg_resolution_hours"),
        F.round(F.col("avg_resolution_hours") - before, 1).alias("change_hours"),
    ).orderBy("year")


def freshness(clean: DataFrame, now: Column) -> DataFrame:
    """Hours between ``now`` and the newest creation time (one row)."""
    newest = clean.agg(F.max("created_at").alias("newest_created_at"))
    age = (now.cast("long") - F.col("newest_created_at").cast("long")) / F.lit(3600.0).cast("double")
    return newest.withColumn("age_hours", age)
