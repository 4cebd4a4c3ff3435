"""Distribution of resolution times: same-call share, exact median, equal-width histogram.

All three start from one (value, count) table. Grouping combines map-side, so a value
held by a third of the rows costs one row per task, and the facts are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow import contracts

VALUE = "resolution_hours"
# Hours are kept to 1/100, so one bucket of this width holds at most 2,400 values.
MEDIAN_BUCKET_HOURS = 24.0


def value_counts(hours: DataFrame, value: str = VALUE) -> DataFrame:
    """Different values with their number of rows."""
    return hours.groupBy(F.col(value).alias(VALUE)).agg(F.count(F.lit(1)).alias("n"))


def resolution_stats(hours: DataFrame) -> DataFrame:
    """One row: population, zero-hour rows and rate, and the median of longer cases.

    The rate is 0 for an empty population and the median NULL without longer cases.
    """
    counts = value_counts(hours)
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("closed_rows"),
        F.coalesce(F.sum(F.when(F.col(VALUE) == 0, F.col("n"))), F.lit(0)).alias("zero_hour_rows"),
    )
    median = exact_median(counts, F.col(VALUE) > 0)
    rate = F.coalesce(F.try_divide(F.col("zero_hour_rows"), F.col("closed_rows")), F.lit(0.0))
    return totals.select(
        "closed_rows",
        "zero_hour_rows",
        rate.alias("zero_hour_rate"),
        median.scalar().alias("median_hours"),
    )


def exact_median(
    counts: DataFrame, wanted: Column | None = None, width: float = MEDIAN_BUCKET_HOURS
) -> DataFrame:
    """Exact median of a (value, count) table, the mean of the middle two if even (one row).

    Bucket totals locate the bucket or two that hold the middle ranks; only their values
    are ranked. Neither the rows nor all different values ever meet in one task.

    Unwanted values weigh nothing instead of being filtered out, and the join is null-safe:
    a filter (or the one an equality join implies) would move below the counting and cost
    a scan of its own, where now all uses share the one counting exchange.
    """
    weight = F.col("n") if wanted is None else F.when(wanted, F.col("n")).otherwise(0)
    bucketed = counts.select(
        F.col(VALUE).cast("double").alias("v"),
        weight.alias("w"),
        F.floor(F.col(VALUE).cast("double") / width).alias("bucket"),
    )
    totals = bucketed.groupBy(F.col("bucket").alias("place")).agg(F.sum("w").alias("size"))
    # One row per bucket of the value range goes through these two windows.
    placed = totals.select(
        "place",
        "size",
        (F.sum("size").over(Window.orderBy("place")) - F.col("size")).alias("before"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    middle = placed.where(_holds(low, "before", "size") | _holds(high, "before", "size"))
    running = F.sum("w").over(Window.partitionBy("bucket").orderBy("v"))
    ranked = bucketed.join(middle, F.col("bucket").eqNullSafe(F.col("place"))).withColumn(
        "first", F.col("before") + running - F.col("w")
    )
    hits = _holds(low, "first", "w").cast("int") + _holds(high, "first", "w").cast("int")
    return ranked.agg((F.sum(F.when(hits > 0, F.col("v") * hits)) / 2.0).alias("median_hours"))


def _holds(rank: Column, before: str, size: str) -> Column:
    """Whether 1-based ``rank`` falls into a run of ``size`` rows after ``before`` rows."""
    return (rank > F.col(before)) & (rank <= F.col(before) + F.col(size))


def histogram(counts: DataFrame, bins: int = contracts.HISTOGRAM_BINS) -> DataFrame:
    """Right-closed equal-width bins of a (value, count) table, empty bins included.

    The lowest value belongs to the first bin. When all values are equal they fall into
    the bin that ends in the middle of a range stretched by 0.1 % to both sides. An empty
    table has no bins.
    """
    value = F.col(VALUE).cast("double")
    # The row total keeps this an aggregate of the counted values; the bounds alone would be
    # taken from the facts in a second scan.
    edges = counts.agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.sum("n").alias("rows")
    ).where(F.col("rows") > 0)
    flat = F.col("lo") == F.col("hi")
    stretch = F.when(F.col("lo") == 0, 0.001).otherwise(F.abs("lo") * 0.001)
    spread = edges.select(
        F.when(flat, F.col("lo") - stretch).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + stretch).otherwise(F.col("hi")).alias("hi"),
        flat.alias("flat"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)

    frame = spread.select("lo", "hi", "width", "flat", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    outline = frame.select(
        "bin",
        _edge(F.col("bin") - 1, bins).alias("bin_low"),
        _edge(F.col("bin"), bins).alias("bin_high"),
    )
    bounds = F.struct("lo", "hi", "width", "flat")
    placed = counts.select(
        value.alias("v"), "n", spread.select(bounds.alias("b")).scalar().alias("b")
    ).select("v", "n", "b.*")
    per_bin = placed.groupBy(_bin_of(F.col("v"), bins).alias("bin")).agg(F.sum("n").alias("n"))
    return (
        outline.join(per_bin, "bin", "left")
        .select("bin", "bin_low", "bin_high", F.coalesce("n", F.lit(0)).alias("request_count"))
        .orderBy("bin")
    )


def _edge(position: Column, bins: int) -> Column:
    """Edge ``position`` of 0..bins; the last one is the maximum itself."""
    return F.when(position == bins, F.col("hi")).otherwise(F.col("lo") + position * F.col("width"))


def _bin_of(value: Column, bins: int) -> Column:
    """Bin of a value: the division's guess, moved when rounding put it past an edge."""
    guess = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((value - F.col("lo")) / F.col("width"))))
    below = (guess > 1) & (value <= _edge(guess - 1, bins))
    above = (guess < bins) & (value > _edge(guess, bins))
    moved = F.when(below, guess - 1).when(above, guess + 1).otherwise(guess)
    return F.when(F.col("flat"), F.lit(bins // 2)).otherwise(moved).cast("int")
