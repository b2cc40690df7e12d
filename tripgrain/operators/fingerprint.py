"""What a dataset holds, as one row that does not depend on the order of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("rows", "low", "high")


def fingerprint_columns(df: DataFrame) -> list[Column]:
    """The number of rows and the sums of two 64-bit hashes of each row: equal bags of rows give equal values, and one
    changed, missing or repeated value changes them. Where a null stands counts too, which the hash alone leaves out."""
    cells = [c for name in df.columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    low, high = F.xxhash64(*cells), F.xxhash64(F.lit("high"), *cells)
    sums = (F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(n) for n, h in zip(FIELDS[1:], (low, high), strict=True))
    return [F.count(F.lit(1)).alias(FIELDS[0]), *sums]


def fingerprint(df: DataFrame) -> DataFrame:
    return df.agg(*fingerprint_columns(df))


def out_of_order(earlier: str, later: str, order: Sequence[str]) -> Column:
    """Whether a row that comes later sorts before the other. `order` names columns, falling with a leading `-`, nulls
    last; the two rows are struct columns."""
    wrong = F.lit(False)
    for key in reversed(order):
        name, falling = key.removeprefix("-"), key.startswith("-")
        a, b = F.col(earlier)[name], F.col(later)[name]
        before = F.coalesce(b > a if falling else b < a, a.isNull() & b.isNotNull())
        wrong = before | (a.eqNullSafe(b) & wrong)
    return wrong
