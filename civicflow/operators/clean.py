"""Raw feed rows to typed, enriched case rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.functions import flags, text, time
from civicflow.operators.dedup import keep_latest


def tidy_text(df: DataFrame, columns: Sequence[str] = tuple(contracts.TRIMMED_COLUMNS)) -> DataFrame:
    """Trim the listed columns and turn blanks into NULL; other text stays as delivered."""
    return df.withColumns({c: text.blank_to_null(F.col(c)) for c in columns})


def parse_dates(
    df: DataFrame, created: str = "Case_Created_Date", closed: str = "Case_Closed_Date"
) -> DataFrame:
    return df.withColumns(
        {
            "created_at": time.from_epoch_ms(F.col(created)),
            "closed_at": time.from_epoch_ms(F.col(closed)),
        }
    )


def derive_fields(
    df: DataFrame,
    *,
    source: str = "Case_Source",
    summary: str = "Case_Summary",
    latitude: str = "Latitude",
    longitude: str = "Longitude",
    latitude_range: tuple[float, float] = contracts.LATITUDE_RANGE,
    longitude_range: tuple[float, float] = contracts.LONGITUDE_RANGE,
) -> DataFrame:
    """Add closing state, resolution time, internal-notice flag and coordinate validity."""
    box = flags.inside_box(F.col(latitude), F.col(longitude), latitude_range, longitude_range)
    return df.withColumns(
        {
            "is_closed": F.col("closed_at").isNotNull(),
            "resolution_hours": time.hours_between(F.col("created_at"), F.col("closed_at")),
            "is_likely_internal": flags.likely_internal(F.col(source), F.col(summary)),
            "has_valid_coordinates": box,
        }
    )


def clean_requests(
    df: DataFrame,
    *,
    order: Sequence[Column] | None = None,
    null_keys: str = "keep",
    row_id: str | None = None,
) -> DataFrame:
    """One typed row per case key: deduplicate, tidy, derive."""
    latest = keep_latest(df, order=order, null_keys=null_keys, row_id=row_id)
    if row_id is not None:
        latest = latest.drop(row_id)
    return latest.transform(tidy_text).transform(parse_dates).transform(derive_fields)
