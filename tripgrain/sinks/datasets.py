"""CSV, JSON and Parquet outputs.

Every writer is an ordinary distributed write: executors produce the files, the driver sees no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrain.operators.fingerprint import FIELDS, fingerprint, fingerprint_columns, out_of_order
from tripgrain.operators.positions import read_in_order


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
    return path


def read_csv_back(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Read an export with its declared schema; the header must name exactly these fields.

    Pruning is off, so a row is parsed, and judged, as a whole whichever columns a consumer reads.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("columnPruning", False).option("mode", mode).csv(path)


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_evidence(datasets: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """One JSON-lines dataset per name below `path`: the summary, the check rows and every published dataset."""
    return {name: write_json(df, f"{path}/{name}") for name, df in datasets.items()}


def observed(df: DataFrame, write: Callable[[DataFrame], object]) -> dict[str, object]:
    """Write a frame and return the fingerprint of the rows as they were written, so they are computed once. It is taken
    in the tasks that write, of which Spark counts one success each."""
    seen = Observation()
    write(df.observe(seen, *fingerprint_columns(df)))
    return seen.get


def _same(expected: Mapping[str, object], stored: DataFrame) -> Column:
    """Whether the fingerprint columns of a one-row frame are those expected."""
    kinds = {name: stored.schema[name].dataType for name in FIELDS}
    return reduce(lambda a, b: a & b, (F.col(n) == F.lit(str(expected[n])).cast(kinds[n]) for n in FIELDS))


def verified_evidence(datasets: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Write the evidence, read each part back with its schema and compare: dataset, documents, evidence_status."""
    spark = next(iter(datasets.values())).sparkSession
    rows = []
    for name, df in datasets.items():
        expected = observed(df, lambda seen, name=name: write_json(seen, f"{path}/{name}"))
        rows.append(compare_evidence(spark, name, df.schema, expected, f"{path}/{name}"))
    return reduce(DataFrame.unionByName, rows)


def compare_evidence(spark: SparkSession, name: str, schema: T.StructType, expected: Mapping[str, object], path: str) -> DataFrame:
    stored = fingerprint(spark.read.schema(schema).option("mode", "FAILFAST").json(path))
    status = F.when(_same(expected, stored), "PASS").otherwise("FAIL")
    return stored.select(F.lit(name).alias("dataset"), F.col("rows").alias("documents"), status.alias("evidence_status"))


def verified_extract(df: DataFrame, path: str, order: Sequence[str] = ()) -> DataFrame:
    """Write Parquet, in the given order of columns (falling with a leading `-`, nulls last), and compare what is read
    back: rows, values and order. One row with both numbers of rows and the status."""
    if order:
        keys = [F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in order]
        arranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    else:
        arranged = df
    expected = observed(arranged, lambda seen: seen.write.mode("overwrite").parquet(path))
    return compare_extract(df.sparkSession, df.schema, expected, path, order)


def compare_extract(spark: SparkSession, schema: T.StructType, expected: Mapping[str, object], path: str, order: Sequence[str] = ()) -> DataFrame:
    """Whether the files at `path` hold the rows of that fingerprint, in that order."""
    stored = fingerprint(spark.read.schema(schema).parquet(path))
    good = _same(expected, stored)
    if order:
        good = good & (misplaced_rows(spark, schema, path, order).scalar() == 0)
    return stored.select(
        F.col("rows").alias("rows_stored"),
        F.lit(expected["rows"]).cast("bigint").alias("rows_expected"),
        F.when(good, "PASS").otherwise("FAIL").alias("extract_status"),
    )


def misplaced_rows(spark: SparkSession, schema: T.StructType, path: str, order: Sequence[str]) -> DataFrame:
    """How many rows of the files sort before the row that lies just before them. Neighbours meet by position, so no task
    sees more than its share of the rows."""
    rows = read_in_order(spark, path, schema, "position")
    keys = F.struct(*(k.removeprefix("-") for k in order))
    one = rows.select(F.col("position").alias("at"), keys.alias("earlier"))
    two = rows.select((F.col("position") - 1).alias("at"), keys.alias("later"))
    return one.join(two, "at").agg(F.count_if(out_of_order("earlier", "later", order)).alias("misplaced"))


def contract_violations(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Check an exported CSV against its fields: how many rows it holds and how many break the contract.

    A row breaks it when its width differs from the schema's or a value does not parse. A header that names
    other fields makes the read fail.
    """
    rows = read_csv_back(spark, path, schema, mode="PERMISSIVE").agg(F.count(F.lit(1)).alias("rows_read"))
    # writing each row out again makes Spark parse all of its fields before it counts
    whole_row = F.to_csv(F.struct(*schema.names))
    kept = read_csv_back(spark, path, schema, mode="DROPMALFORMED").agg(F.count(whole_row).alias("rows_kept"))
    return rows.withColumn("rows_broken", F.col("rows_read") - kept.scalar()).withColumn(
        "contract_status", F.when(F.col("rows_broken") == 0, "PASS").otherwise("FAIL")
    )
