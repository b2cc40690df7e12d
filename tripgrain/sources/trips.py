"""Trip records in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrain.spec import TripSpec


def read_trips(spark: SparkSession, path: str | list[str], spec: TripSpec) -> DataFrame:
    """Read one file, a folder or several; columns the spec does not name pass through unchanged."""
    paths = [path] if isinstance(path, str) else path
    return require_columns(spark.read.parquet(*paths), spec)


def require_columns(trips: DataFrame, spec: TripSpec) -> DataFrame:
    """Check that the columns the spec names exist and take wall-clock times as wall-clock times."""
    missing = [c for c in spec.trip_columns if c not in trips.columns]
    if missing:
        raise ValueError(f"trip table lacks {missing}")
    zoned = [
        c for c in (spec.pickup_ts, spec.dropoff_ts) if isinstance(trips.schema[c].dataType, T.TimestampType)
    ]
    return trips.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else trips
