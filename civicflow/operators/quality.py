"""The quality gate: every check of a batch from one aggregate, one result row per check."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.functions import flags, text

HARD = "hard"
WARNING = "warning"
INFO = "info"

REPORT_COLUMNS = ["check_name", "severity", "value", "threshold", "failed", "message"]


class QualityGateError(RuntimeError):
    """A batch broke at least one hard check."""


@dataclass(frozen=True)
class Check:
    """One rule over a batch.

    ``measure`` is an aggregate that yields one number; ``fails`` turns it into a boolean,
    where NULL (nothing to measure) counts as passed; ``message`` describes a failure.
    A user's own check is one more instance in the list given to the gate.
    """

    name: str
    severity: str
    measure: Column
    fails: Callable[[Column], Column]
    message: Callable[[Column], Column]
    threshold: float


@dataclass
class GateResult:
    row_count: int = 0
    hard_failures: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    measures: dict[str, float | None] = field(default_factory=dict)

    @property
    def passed(self) -> bool:
        return not self.hard_failures


def count_check(name: str, condition: Column, what: str) -> Check:
    """Hard check that no row meets ``condition``."""
    return Check(
        name,
        HARD,
        F.count_if(condition).cast("double"),
        lambda v: v > 0,
        lambda v: F.format_string(f"%d rows {what}", v.cast("long")),
        0.0,
    )


def info(name: str, measure: Column) -> Check:
    """A figure reported next to the checks; it cannot fail."""
    return Check(name, INFO, measure.cast("double"), lambda v: F.lit(False), lambda v: F.lit(""), 0.0)


def key_not_null(key: str = "OBJECTID") -> Check:
    return count_check("key_not_null", F.col(key).isNull(), f"have a null {key}")


def key_unique(key: str = "OBJECTID") -> Check:
    """Hard check that rows and distinct keys agree; NULL counts as one key."""
    return Check(
        "key_unique",
        HARD,
        (F.count(F.lit(1)) - distinct_keys(F.col(key))).cast("double"),
        lambda v: v > 0,
        lambda v: F.format_string(f"{key} is not unique: %d surplus rows", v.cast("long")),
        0.0,
    )


def created_not_null(created: str = "created_at") -> Check:
    return count_check("created_at_not_null", F.col(created).isNull(), f"have a null {created}")


def closed_after_created(created: str = "created_at", closed: str = "closed_at") -> Check:
    early = flags.closed_too_early(F.col(created), F.col(closed))
    return count_check("closed_before_created", early, f"have {closed} before {created}")


def internal_rate(
    flag: str = "is_likely_internal", limit: float = contracts.MAX_INTERNAL_RATE
) -> Check:
    """Warns above ``limit``; NULL flags count as rows but not as internal."""
    share = F.count_if(F.col(flag)) / F.count(F.lit(1))
    return Check(
        "internal_rate",
        WARNING,
        F.when(F.count(F.lit(1)) > 0, share),
        lambda v: v > limit,
        lambda v: F.concat(
            text.percent_text(v), F.lit(" of rows look internal, limit "), text.percent_text(F.lit(limit))
        ),
        limit,
    )


def coordinate_rate(
    flag: str = "has_valid_coordinates",
    latitude: str = "Latitude",
    limit: float = contracts.MIN_COORDINATE_RATE,
) -> Check:
    """Warns below ``limit`` among the rows that have a latitude at all."""
    tried = F.col(latitude).isNotNull()
    attempts = F.count_if(tried)
    return Check(
        "coordinate_rate",
        WARNING,
        F.when(attempts > 0, F.count_if(tried & F.col(flag)) / F.nullif(attempts, F.lit(0))),
        lambda v: v < limit,
        lambda v: F.concat(F.lit("only "), text.percent_text(v), F.lit(" of located rows are inside the area")),
        limit,
    )


def share_limit(name: str, condition: Column, limit: float, what: str) -> Check:
    """Hard check that at most ``limit`` of the rows meet ``condition``."""
    rows = F.count(F.lit(1))
    return Check(
        name,
        HARD,
        F.when(rows > 0, F.count_if(condition) / F.nullif(rows, F.lit(0))),
        lambda v: v > limit,
        lambda v: F.concat(text.percent_text(v), F.lit(f" of rows {what}, limit "), text.percent_text(F.lit(limit))),
        limit,
    )


def corrupt_rate(column: str = contracts.CORRUPT_COLUMN, limit: float = 0.0) -> Check:
    """Warns when more than ``limit`` of the raw lines did not fit the declared schema."""
    rows = F.count(F.lit(1))
    return Check(
        "corrupt_rate",
        WARNING,
        F.when(rows > 0, F.count(F.col(column)) / rows),
        lambda v: v > limit,
        lambda v: F.concat(text.percent_text(v), F.lit(" of lines do not match the schema")),
        limit,
    )


def default_checks() -> list[Check]:
    return [
        key_not_null(),
        key_unique(),
        created_not_null(),
        closed_after_created(),
        internal_rate(),
        coordinate_rate(),
    ]


def distinct_keys(key: Column) -> Column:
    """Aggregate: number of different keys, NULL being one of them."""
    return F.count_distinct(key) + F.when(F.count_if(key.isNull()) > 0, 1).otherwise(0)


def quality_report(
    df: DataFrame,
    checks: Sequence[Check] | None = None,
    required: Sequence[str] = tuple(contracts.REQUIRED_BY_GATE),
) -> DataFrame:
    """One row per check, computed in a single scan with a single aggregate.

    A missing required column is reported alone: the other checks could not even be
    analysed without it.
    """
    missing = missing_columns(df, required)
    if missing:
        return _missing_report(df, missing)
    checks = list(checks) if checks is not None else default_checks()

    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(check.measure.alias(f"m{i}") for i, check in enumerate(checks)),
    )
    rows = [_report_row(F.lit("row_count"), F.lit(INFO), F.col("rows").cast("double"))]
    rows += [_check_row(check, F.col(f"m{i}")) for i, check in enumerate(checks)]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _check_row(check: Check, value: Column) -> Column:
    failed = F.coalesce(check.fails(value), F.lit(False))
    return _report_row(
        F.lit(check.name),
        F.lit(check.severity),
        value.cast("double"),
        F.lit(None if check.severity == INFO else float(check.threshold)).cast("double"),
        failed,
        F.when(failed, check.message(value)),
    )


def _report_row(
    name: Column,
    severity: Column,
    value: Column,
    threshold: Column | None = None,
    failed: Column | None = None,
    message: Column | None = None,
) -> Column:
    parts = [
        name,
        severity,
        value,
        threshold if threshold is not None else F.lit(None).cast("double"),
        failed if failed is not None else F.lit(False),
        message if message is not None else F.lit(None).cast("string"),
    ]
    return F.struct(*(p.alias(c) for p, c in zip(parts, REPORT_COLUMNS)))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def _missing_report(df: DataFrame, missing: list[str]) -> DataFrame:
    row = _report_row(
        F.lit("required_columns"),
        F.lit(HARD),
        F.lit(float(len(missing))),
        F.lit(0.0),
        F.lit(True),
        F.lit("Missing required columns: " + ", ".join(missing)),
    )
    counted = _report_row(F.lit("row_count"), F.lit(INFO), F.col("rows").cast("double"))
    totals = df.agg(F.count(F.lit(1)).alias("rows"))
    return totals.select(F.explode(F.array(counted, row)).alias("r")).select("r.*")


def gate_result(report: DataFrame) -> GateResult:
    """Read a report (one row per check) back as a verdict."""
    result = GateResult()
    for row in report.collect():
        result.measures[row["check_name"]] = row["value"]
        if row["check_name"] == "row_count":
            result.row_count = int(row["value"])
        elif row["failed"]:
            target = result.hard_failures if row["severity"] == HARD else result.warnings
            target.append(row["message"])
    return result


def require_pass(result: GateResult) -> GateResult:
    if not result.passed:
        raise QualityGateError(
            f"{len(result.hard_failures)} hard check(s) failed: " + "; ".join(result.hard_failures)
        )
    return result


def run_gate(df: DataFrame, checks: Sequence[Check] | None = None) -> GateResult:
    """Run the checks; raise :class:`QualityGateError` on a hard failure, keep warnings."""
    return require_pass(gate_result(quality_report(df, checks)))


def row_problems(
    key: str = "OBJECTID", created: str = "created_at", closed: str = "closed_at"
) -> Column:
    """Names of the row-level hard checks a row breaks, as an array (empty for a good row)."""
    early = flags.closed_too_early(F.col(created), F.col(closed))
    found = F.array(
        F.when(F.col(key).isNull(), F.lit("key_not_null")),
        F.when(F.col(created).isNull(), F.lit("created_at_not_null")),
        F.when(early, F.lit("closed_before_created")),
    )
    return F.array_compact(found)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that break no row-level check, and the others with their ``problems``."""
    marked = df.withColumn("problems", row_problems())
    good = marked.where(F.size("problems") == 0).drop("problems")
    return good, marked.where(F.size("problems") > 0)


def contract_diff(
    df: DataFrame, contract: Sequence[tuple[str, str]] = tuple(contracts.RAW_FEED)
) -> DataFrame:
    """Differences between a DataFrame's columns and a declared contract.

    ``change`` is ``missing`` (declared, not delivered), ``added`` or ``retyped``.
    """
    session = df.sparkSession
    declared = session.createDataFrame(list(contract), "name string, declared_type string")
    actual = session.createDataFrame(df.dtypes, "name string, actual_type string")
    change = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("declared_type").isNull(), "added")
        .when(F.col("actual_type") != F.col("declared_type"), "retyped")
    )
    both = declared.join(actual, "name", "full_outer").withColumn("change", change)
    return both.where(F.col("change").isNotNull()).select("name", "change", "declared_type", "actual_type")


def contract_profile(
    df: DataFrame, contract: Sequence[tuple[str, str]] = tuple(contracts.RAW_FEED)
) -> DataFrame:
    """Per declared column: delivered type, agreement, and how many rows carry a value."""
    delivered = dict(df.dtypes)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count(F.col(c)).alias(f"n_{c}") for c, _ in contract if c in delivered),
    )
    lines = [
        F.struct(
            F.lit(column).alias("name"),
            F.lit(kind).alias("declared_type"),
            F.lit(delivered.get(column)).cast("string").alias("actual_type"),
            F.lit(delivered.get(column) == kind).alias("matches"),
            (F.col(f"n_{column}") if column in delivered else F.lit(0).cast("long")).alias("filled"),
            F.col("rows").alias("total"),
        )
        for column, kind in contract
    ]
    return counted.select(F.explode(F.array(*lines)).alias("r")).select("r.*")
