"""The location lookup and the bound under which it may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.spec import TripSpec

# Some hundred locations are usual: some kilobytes.
BROADCAST_BYTES = 8 << 20


def read_lookup(spark: SparkSession, path: str, spec: TripSpec) -> DataFrame:
    """Read the CSV with its declared schema; `enforceSchema=False` makes Spark compare the header."""
    return spark.read.schema(spec.lookup_schema()).option("header", True).option("enforceSchema", False).csv(path)


def bounded(small: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the optimizer's estimate of the size is at most `limit` bytes; no job is run.

    A larger table, or one of unknown size, is returned unhinted: Spark then compares what it measures with its
    own threshold, and in a sort-merge join the adaptive skew rule splits a location with many trips.
    """
    size = int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(small) if size <= limit else small
