"""The case fact: staging a batch against the dimensions, and merging it by case key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.functions import numbers, text, time

FACT = "fact_service_request"
FACT_COLUMNS = contracts.names(contracts.STAR_TABLES[FACT])
MONTH = "created_month"


def created_month(created_at: Column) -> Column:
    """Year and month of creation as one number; the part of the fact a case is stored in."""
    return (F.year(created_at) * 100 + F.month(created_at)).cast("int")


def stage_facts(
    batch: DataFrame,
    agency: DataFrame,
    service_type: DataFrame,
    neighborhood: DataFrame,
    loaded_at: Column,
) -> DataFrame:
    """Clean cases as fact rows; an unknown natural key leaves a NULL foreign key.

    The joins carry no hint: stored dimensions have a known size, so the session's
    broadcast threshold decides, and a dimension beyond it is sort-merge joined with
    skewed (and NULL) names split by AQE.
    """
    cases = batch.select(
        F.col("OBJECTID").alias("object_id"),
        F.col("Agency").alias("agency_name"),
        F.col("Type").alias("type_name"),
        F.col("Topic").alias("topic_name"),
        F.col("Neighborhood").alias("neighborhood_name"),
        time.date_key(F.col("created_at")).alias("created_date_key"),
        "created_at",
        "closed_at",
        F.col("Case_Status").alias("case_status"),
        F.col("Case_Source").alias("case_source"),
        numbers.false_if_null(F.col("is_closed")).alias("is_closed"),
        numbers.stored_hours(F.col("resolution_hours")).alias("resolution_hours"),
        numbers.false_if_null(F.col("is_likely_internal")).alias("is_likely_internal"),
        numbers.false_if_null(F.col("has_valid_coordinates")).alias("has_valid_coordinates"),
        numbers.double_or_null(F.col("Latitude")).alias("latitude"),
        numbers.double_or_null(F.col("Longitude")).alias("longitude"),
        F.col("Incident_Address_1").alias("incident_address"),
        loaded_at.alias("loaded_at"),
    )
    return (
        cases.join(agency.select("agency_key", "agency_name"), ["agency_name"], "left")
        .join(
            service_type.select("service_type_key", "type_name", "topic_name"),
            ["type_name", "topic_name"],
            "left",
        )
        .join(
            neighborhood.select("neighborhood_key", "neighborhood_name"), ["neighborhood_name"], "left"
        )
        .select(*FACT_COLUMNS)
    )


def merge_facts(current: DataFrame | None, staged: DataFrame) -> DataFrame:
    """Current facts with the staged ones merged in by ``object_id``.

    New keys are inserted whole. On a known key only the columns in
    ``contracts.FACT_UPDATED_COLUMNS`` change, and they change to the staged value even
    when that is NULL (a reopened case). Both sides hold a key at most once, so one key
    cannot be hot.
    """
    if current is None:
        return staged.select(*FACT_COLUMNS)
    held = current.select(*FACT_COLUMNS, F.lit(True).alias("_held"))
    offered = staged.select(
        "object_id",
        *(F.col(c).alias(f"_new_{c}") for c in FACT_COLUMNS if c != "object_id"),
        F.lit(True).alias("_offered"),
    )

    def merged(column: str) -> Column:
        old, new = F.col(column), F.col(f"_new_{column}")
        if column in contracts.FACT_UPDATED_COLUMNS:
            return F.when(F.col("_offered"), new).otherwise(old).alias(column)
        return F.when(F.col("_held"), old).otherwise(new).alias(column)

    joined = held.join(offered, "object_id", "full_outer")
    return joined.select("object_id", *(merged(c) for c in FACT_COLUMNS if c != "object_id"))


def load_counts(batch: DataFrame) -> DataFrame:
    """Rows of a batch that attempt an upsert, per target table (one row).

    An attempt is counted as soon as any part of a natural key is present; a service type
    with one part counts here although it gets no member.
    """

    def attempts(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    either = text.is_present(F.col("Type")) | text.is_present(F.col("Topic"))
    return batch.agg(
        attempts(text.is_present(F.col("Agency")), contracts.LOAD_COUNTS["dim_agency"]),
        attempts(F.coalesce(either, F.lit(False)), contracts.LOAD_COUNTS["dim_service_type"]),
        attempts(text.is_present(F.col("Neighborhood")), contracts.LOAD_COUNTS["dim_neighborhood"]),
        attempts(F.col("created_at").isNotNull(), contracts.LOAD_COUNTS["dim_date"]),
        F.count(F.lit(1)).alias(contracts.LOAD_COUNTS[FACT]),
    )
