"""Check rows: a named comparison of an actual with an expected value.

All checks of a suite are expressions over one row of metrics and are spread into rows by `inline`, so a
suite with ten checks costs the aggregates behind its metrics once, not ten unions over them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.logic import all_of, differs
from tripgrain.functions.numeric import as_double

VALUE = "decimal(38,6)"
CHECK_COLUMNS = (
    "suite",
    "check_order",
    "check_name",
    "actual_value",
    "expected_value",
    "tolerance",
    "difference",
    "check_status",
)


@dataclass(frozen=True)
class Check:
    name: str
    actual: Column
    expected: Column = field(default_factory=lambda: F.lit(0))
    tolerance: Column = field(default_factory=lambda: F.lit(0))


def equal(name: str, actual: Column, expected: Column) -> Check:
    """Two counts or sums must agree exactly."""
    return Check(name, actual, expected)


def none_of(name: str, violations: Column) -> Check:
    """No row may break the rule."""
    return Check(name, violations)


def reconciles(name: str, actual: Column, expected: Column, within: str) -> Check:
    """Two sums must agree within a fixed tolerance, given as decimal text."""
    return Check(name, actual, expected, F.lit(within).cast(VALUE))


def reconciles_rounded(name: str, actual: Column, expected: Column, groups: Column, half_unit: str) -> Check:
    """A sum of values rounded per group may be off by half a unit per group."""
    return Check(name, actual, expected, groups * F.lit(half_unit).cast("decimal(10,6)") + F.lit("0.01").cast("decimal(4,2)"))


def unique(name: str, rows: Column, distinct_keys: Column) -> Check:
    return Check(name, rows - distinct_keys)


def one_row_per(name: str, rows: Column, source_groups: Column) -> Check:
    return Check(name, rows, source_groups)


def spans(name: str, first: Column, last: Column, days: int) -> Check:
    """First to last date, both included, is the expected number of calendar days."""
    return Check(name, F.datediff(last, first) + 1, F.lit(days))


def parts_make_whole(name: str, parts: list[Column], whole: Column) -> Check:
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return Check(name, total, whole)


def far(a: Column, b: Column, tolerance: float) -> Column:
    """Further apart than the tolerance; unknown, hence not counted, when either is null."""
    return F.abs(as_double(a) - as_double(b)) > tolerance


def far_or_one_sided(a: Column, b: Column, tolerance: float) -> Column:
    """Further apart than the tolerance, or null on one side only."""
    return differs(a, b) & (a.isNull() | b.isNull() | far(a, b, tolerance))


def check_rows(suite: str, metrics: DataFrame, checks: list[Check]) -> DataFrame:
    """Spread the checks over a one-row frame of metrics. Values are compared as decimals, shown as doubles.

    A check passes only if both values are known and no further apart than its tolerance.
    """
    rows = [
        F.struct(
            F.lit(suite).alias("suite"),
            F.lit(order).alias("check_order"),
            F.lit(check.name).alias("check_name"),
            check.actual.cast(VALUE).alias("a"),
            check.expected.cast(VALUE).alias("e"),
            check.tolerance.cast(VALUE).alias("t"),
        )
        for order, check in enumerate(checks, start=1)
    ]
    apart = F.col("a") - F.col("e")
    passed = all_of(F.col("a").isNotNull(), F.col("e").isNotNull(), F.abs(apart) <= F.col("t"))
    return metrics.select(F.inline(F.array(*rows))).select(
        "suite",
        "check_order",
        "check_name",
        as_double(F.col("a")).alias("actual_value"),
        as_double(F.col("e")).alias("expected_value"),
        as_double(F.col("t")).alias("tolerance"),
        as_double(apart).alias("difference"),
        F.when(passed, "PASS").otherwise("FAIL").alias("check_status"),
    )


def failures(checks: DataFrame) -> DataFrame:
    return checks.where(differs(F.col("check_status"), F.lit("PASS")))


class ChecksFailed(RuntimeError):
    """At least one check row is not PASS."""


def enforce(checks: DataFrame) -> None:
    """Stop before anything is published. Check rows are few by construction, so failures come to the driver."""
    failed = failures(checks).orderBy("suite", "check_order").collect()
    if failed:
        raise ChecksFailed(
            "; ".join(f"{r.suite}.{r.check_order} {r.check_name}: {r.actual_value} != {r.expected_value}" for r in failed)
        )
