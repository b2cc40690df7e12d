"""Joins on keys that may be null, and values of one-row frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.logic import all_of, same


def null_safe_join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join two frames as `a` and `b` where every key is equal or null on both sides.

    Spark plans the null-safe equality as an ordinary equi-join (hash or sort-merge).
    """
    return a.alias("a").join(b.alias("b"), all_of(*(same(F.col(f"a.{k}"), F.col(f"b.{k}")) for k in keys)), how)


def only_row(df: DataFrame) -> Column:
    """The one row of an aggregate as a struct-valued scalar subquery.

    Puts a grand total next to every row without joining.
    """
    return df.select(F.struct(*df.columns).alias("only_row")).scalar()
