"""Ranking without a one-partition window over all entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, k: int, *order: Column, rank: str | None = None) -> DataFrame:
    """The first k rows of an ordering, numbered if asked.

    `orderBy.limit` keeps k rows per task before anything moves; only those few rows meet the
    unpartitioned window that numbers them. The ordering must end in a unique key to be deterministic.
    """
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint")) if rank else best


def first_in(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the first of the ordering.

    The rank filter lets Spark cut each key to one row per task before the shuffle.
    """
    ranked = df.withColumn("place_in_key", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("place_in_key") == 1).drop("place_in_key")
