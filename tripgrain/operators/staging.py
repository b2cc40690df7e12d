"""Flag implausible trips of the reporting period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.logic import any_of, known
from tripgrain.functions.temporal import seconds_between, to_minutes, with_interval_text
from tripgrain.spec import TripSpec

FLAGS = ("has_nonpositive_duration", "has_nonpositive_distance", "has_excessive_distance", "has_invalid_amount")
VALID = "is_valid_completed_trip"


def in_period(spec: TripSpec) -> Column:
    """Pickup inside the half-open period, written as two plain comparisons so that Parquet can skip row groups."""
    pickup = F.col(spec.pickup_ts)
    return (pickup >= wall_clock(spec.period_start)) & (pickup < wall_clock(spec.period_end))


def wall_clock(moment) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def with_duration(trips: DataFrame, start: str, end: str) -> DataFrame:
    """Add elapsed time as text and as minutes."""
    trips = with_interval_text(trips, start, end, "trip_duration_hms")
    trips = trips.withColumn("elapsed_seconds", seconds_between(F.col(start), F.col(end)))
    return trips.withColumn("trip_duration_minutes", to_minutes("elapsed_seconds")).drop("elapsed_seconds")


def clean_trips(trips: DataFrame, spec: TripSpec) -> DataFrame:
    """Every raw column of the period's trips plus duration, four flags and the verdict.

    A comparison with a missing measure is unknown and raises no flag, so such a trip stays valid.
    One narrow pass: no shuffle, no Python.
    """
    rules = (
        F.col(spec.dropoff_ts) <= F.col(spec.pickup_ts),
        F.col(spec.distance) <= 0,
        F.col(spec.distance) > spec.max_distance,
        any_of(F.col(spec.total) <= 0, F.col(spec.fare) < 0),
    )
    timed = with_duration(trips.where(in_period(spec)), spec.pickup_ts, spec.dropoff_ts)
    flagged = timed.withColumns({flag: known(rule) for flag, rule in zip(FLAGS, rules)})
    return flagged.withColumn(VALID, ~any_of(*(F.col(flag) for flag in FLAGS)))
