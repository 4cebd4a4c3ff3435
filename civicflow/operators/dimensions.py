"""Star-schema dimensions: new members, first-seen attributes, stable surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.functions import numbers, text, time
from civicflow.session import shuffle_partitions

_JOINED_BY = "\u0001"


def new_members(
    existing: DataFrame | None, incoming: DataFrame, key: str, natural: Sequence[str]
) -> DataFrame:
    """Unseen ``incoming`` members with new keys.

    ``incoming`` holds one row per natural key. Members already present win, attributes
    included, so a dimension never changes what it said before and only grows.
    """
    columns = [key, *incoming.columns]
    if existing is None:
        return assign_keys(incoming, key, natural).select(*columns)
    fresh = incoming.join(existing.select(*natural), list(natural), "left_anti")
    base = F.coalesce(existing.agg(F.max(key)).scalar(), F.lit(0))
    return assign_keys(fresh, key, natural, base).select(*columns)


def with_new(existing: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """The whole dimension: what was there, and the new members."""
    return fresh if existing is None else existing.select(*fresh.columns).unionByName(fresh)


def assign_keys(
    members: DataFrame,
    key: str,
    natural: Sequence[str],
    base: Column | None = None,
    ranges: int | None = None,
    kind: str = "int",
) -> DataFrame:
    """Number distinct members densely from ``base`` + 1 on, without putting them all in one task.

    The order is that of a digest of the natural key. Members are dealt to equal ranges of the
    digest (default: as many as a shuffle starts with); a member's key is the number of members in
    the ranges before its own, plus its rank inside. So keys do not depend on the number of ranges.
    """
    base = base if base is not None else F.lit(0)
    ranges = ranges or shuffle_partitions(members.sparkSession)
    digest = F.md5(F.concat_ws(_JOINED_BY, *natural))
    first = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long")
    dealt = members.withColumn("_digest", digest).withColumn("_range", F.floor(first * ranges / 2**32).cast("int"))
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range.
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy("_digest", *natural))
    numbered = dealt.withColumn("_rank", rank).join(starts, "_range")
    number = (base + F.col("_start") + F.col("_rank")).cast(kind)
    return numbered.withColumn(key, number).drop("_digest", "_range", "_rank", "_start")


def named_members(batch: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct combinations of source columns, renamed; every part must be present."""
    picked = batch.select(*(F.col(source).alias(name) for source, name in columns.items()))
    for name in columns.values():
        picked = picked.where(text.is_present(F.col(name)))
    return picked.distinct()


def new_agencies(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    incoming = named_members(batch, {"Agency": "agency_name"})
    return new_members(existing, incoming, "agency_key", ["agency_name"])


def new_service_types(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Members need both parts; a case with only one of them has no service type."""
    incoming = named_members(batch, {"Type": "type_name", "Topic": "topic_name"})
    return new_members(existing, incoming, "service_type_key", ["type_name", "topic_name"])


def new_neighborhoods(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Members carry the districts of their earliest case (by creation, then key)."""
    found = batch.where(text.is_present(F.col("Neighborhood")))
    # Two steps: the large one groups on plain columns and keeps one number, so it stays a
    # hash aggregate with map-side combine; the second sees a handful of rows per member.
    per_district = found.groupBy(
        F.col("Neighborhood").alias("neighborhood_name"),
        numbers.int_or_null(F.col("Council_District")).alias("council_district"),
        numbers.int_or_null(F.col("Police_District")).alias("police_district"),
    ).agg(F.min(arrival(F.col("created_at"), F.col("OBJECTID"))).alias("_arrival"))
    districts = F.struct("council_district", "police_district")
    incoming = (
        per_district.groupBy("neighborhood_name")
        .agg(F.min_by(districts, F.col("_arrival")).alias("_first"))
        .select("neighborhood_name", "_first.*")
    )
    return new_members(existing, incoming, "neighborhood_key", ["neighborhood_name"])


def arrival(created_at: Column, key: Column) -> Column:
    """One sortable number for (creation time, key), missing parts last.

    The step between two milliseconds is wider than the whole range of a 64-bit key.
    """
    instant = F.coalesce(time.to_epoch_ms(created_at), F.lit(10**17)).cast("decimal(18,0)")
    step = F.lit("20000000000000000000").cast("decimal(20,0)")
    number = F.coalesce(key, F.lit(2**63 - 1)).cast("decimal(19,0)")
    return (instant * step + number).cast("decimal(38,0)")


def new_dates(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One member per creation day; the key is the day itself, so nothing is numbered."""
    days = (
        batch.where(F.col("created_at").isNotNull())
        .select(F.to_date("created_at").alias("full_date"))
        .distinct()
    )
    incoming = days.select(*(c.alias(n) for n, c in time.date_attributes(F.col("full_date")).items()))
    if existing is None:
        return incoming
    return incoming.join(existing.select("date_key"), "date_key", "left_anti").select(*incoming.columns)


def agencies(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return with_new(existing, new_agencies(batch, existing))


def service_types(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return with_new(existing, new_service_types(batch, existing))


def neighborhoods(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return with_new(existing, new_neighborhoods(batch, existing))


def dates(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return with_new(existing, new_dates(batch, existing))
