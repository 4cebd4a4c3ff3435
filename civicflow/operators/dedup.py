"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow import contracts

_RANK = "_keep_rank"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = ("OBJECTID",),
    order: Sequence[Column] | None = None,
    *,
    null_keys: str = "keep",
    row_id: str | None = None,
) -> DataFrame:
    """The first row of every key by ``order`` (default: :func:`recency`).

    ``row_number() = 1`` is planned as a rank limit on both sides of the exchange, so a
    key that holds a large share of the rows sends one row per input task.

    ``null_keys`` decides about rows with a NULL key part: ``"keep"`` passes all of them
    on, so that a quality gate can count them, ``"collapse"`` treats NULL as one more key.
    With ``"keep"`` and a ``row_id`` column (unique, and stable when a task is repeated,
    such as :func:`civicflow.sources.landing.read_landed` adds) the rows need one scan;
    without it the NULL-key rows are read by a second, filtered branch.
    """
    if null_keys not in ("keep", "collapse"):
        raise ValueError(f"null_keys must be 'keep' or 'collapse', not {null_keys!r}")
    order = list(order) if order is not None else recency(df, exclude=keys)
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()

    if null_keys == "collapse":
        return _first_row(df, [F.col(k) for k in keys], order)
    if row_id is not None:
        own_group = F.when(has_null, F.col(row_id))
        return _first_row(df, [*(F.col(k) for k in keys), own_group], order)
    ranked = _first_row(df.where(~has_null), [F.col(k) for k in keys], order)
    return ranked.unionByName(df.where(has_null))


def _first_row(df: DataFrame, group: list[Column], order: list[Column]) -> DataFrame:
    # The group is one struct value, so rows that a join already partitioned by the bare key
    # are exchanged again - after the rank limit, hence only one row per task and key. Reusing
    # the join's partitioning would leave a hot key's rows in one task. The hash in front is
    # what the sort compares.
    whole = F.struct(*group)
    rank = F.row_number().over(Window.partitionBy(F.xxhash64(*group), whole).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def recency(
    df: DataFrame,
    created: str = "Case_Created_Date",
    closed: str = "Case_Closed_Date",
    exclude: Sequence[str] = (),
) -> list[Column]:
    """Newest first, without ties between different rows.

    A re-delivered case keeps its creation time, so the landing partition decides next
    (later delivery wins), then the closing time, then every other column.
    """
    landed = contracts.names(contracts.LANDING_PARTITIONS)
    leading = [c for c in [created, *landed, closed] if c in df.columns]
    rest = [c for c in df.columns if c not in leading and c not in exclude]
    return [F.col(c).desc_nulls_last() for c in [*leading, *rest]]


def drop_probable_copies(
    df: DataFrame,
    parts: Sequence[str] = ("created_at", "Incident_Address_1", "Type"),
    order: Sequence[Column] | None = None,
    row_key: str | None = None,
) -> DataFrame:
    """Second pass for feeds whose keys were reissued: one row per same time, place and kind.

    Rows with a missing part cannot be told apart and all stay. With a ``row_key``, a column that
    is unique and never NULL as it is behind the quality gate, they pass through the same scan and
    exchange as the others, each as a group of its own; without one a second branch reads them.
    """
    order = list(order) if order is not None else [F.col("OBJECTID").desc_nulls_last()]
    return keep_latest(df, parts, order, null_keys="keep", row_id=row_key)
