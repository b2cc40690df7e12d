"""Global row numbers of a sorted dataset, without a window over all rows.

The rows are dealt by ranges, sorted within each range and written; the numbered files then lie in the order of the
ranges, and Parquet tells a row's place in its file. A row's position is that place plus the rows of all files before.
Only the table of files, one row each, is ever summed up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrain.functions.logic import all_of, same
from tripgrain.session import durable, run_dir


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores added until no column of `df` has that name (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_file_place(stored: DataFrame, file: str, row: str) -> DataFrame:
    """A Parquet table just read, with the name of each row's file and its place there, from 0.

    Unlike a generated number, the pair stays the same however often and in whatever splits the table is read, so it
    tells equal rows apart and survives a lost executor.
    """
    meta = stored.metadataColumn("_metadata")
    return stored.select("*", meta["file_name"].alias(file), meta["row_index"].alias(row))


def write_in_order(df: DataFrame, path: str, *order: Column) -> None:
    """Write Parquet files that lie, one after the other, in the given order. Sampling for the ranges computes `df` once
    more, so `df` should be stored or cheap. Rows equal in all of `order` share a file: end it with a key that tells
    them apart where many may be equal."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)


def read_in_order(spark: SparkSession, path: str, schema: T.StructType, name: str = "position") -> DataFrame:
    """The rows of such a folder, or of any folder of numbered Parquet files, with their position from 0."""
    rows = spark.read.schema(schema).parquet(path)
    file, place = free_name(rows, "file_of_row"), free_name(rows, "place_in_file")
    tagged = with_file_place(rows, file, place)
    sizes = tagged.groupBy(F.col(file).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    task, part = (F.regexp_extract("name", pattern, 1).try_cast("long") for pattern in (r"part-(\d+)", r"-c(\d+)"))
    before = Window.orderBy(task, part, "name").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    first = free_name(rows, "rows_before")
    offsets = sizes.select(F.col("name").alias(file), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(first))
    offsets = durable(offsets, "file-offsets")  # its size is then known, and decides how it is joined
    position = (F.col(first) + F.col(place)).alias(name)
    return tagged.join(offsets, file).select(*(rows[c] for c in rows.columns if c != name), position)


def with_positions(df: DataFrame, *order: Column, name: str = "position", within: Sequence[str] = ()) -> DataFrame:
    """`df` with each row's place, from 0, in the order; with `within`, its place among the rows equal in those columns
    (nulls equal), by which the order must then start. The sorted copy is stored, so places never change afterwards."""
    path = run_dir(df.sparkSession, "in-order")
    write_in_order(df, path, *order)
    placed = read_in_order(df.sparkSession, path, df.schema, name)
    if not within:
        return placed
    keys = [free_name(df, f"{c}_of_first") for c in within]
    first = free_name(placed, "first_position")
    firsts = placed.groupBy(*(F.col(c).alias(k) for c, k in zip(within, keys, strict=True))).agg(F.min(name).alias(first))
    firsts = durable(firsts, "first-positions")
    joined = placed.join(firsts, all_of(*(same(placed[c], firsts[k]) for c, k in zip(within, keys, strict=True))))
    return joined.withColumn(name, F.col(name) - F.col(first)).drop(first, *keys)
