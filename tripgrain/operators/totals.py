"""Additive trip totals at a chosen grain.

Every report is an aggregate of these totals, so a report needs one pass over the trips at its own grain,
or none when it rolls up totals that are already stored at a finer grain. Rows leave each mapper already
combined: a key that holds a third of all trips reaches the shuffle as one row per task. Sums of doubles stay in limbs
(`functions.numeric`), so totals add up without rounding at whatever grain; reports turn them into doubles at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.numeric import add_parts, exact_parts
from tripgrain.spec import CROSS_ZONE, SAME_ZONE, TripSpec

COUNTS = (
    "trips",
    "reported_trips",
    "paid_trips",
    "timed_trips",
    "measured_trips",
    "same_place_trips",
    "other_place_trips",
)
SUMS = ("passengers", "fares", "payments", "miles", "minutes")

# The grain that serves all reports but the routes, and the grain that serves the routes.
PLACE_HOUR = ("pickup_date", "pickup_hour", "origin_id", "pickup_zone", "pickup_borough")
ROUTE = ("pickup_zone", "dropoff_zone", "route_category")


def with_keys(enriched: DataFrame, spec: TripSpec) -> DataFrame:
    """Add the keys that are derived from a trip: its hour, its origin and its route category."""
    same_place = F.col(spec.origin_id) == F.col(spec.dest_id)
    return enriched.withColumns(
        {
            "pickup_hour": F.hour(spec.pickup_ts).cast("bigint"),
            "origin_id": F.col(spec.origin_id),
            "route_category": F.when(same_place, SAME_ZONE).otherwise(CROSS_ZONE),
        }
    )


def trip_totals(enriched: DataFrame, spec: TripSpec, *keys: str) -> DataFrame:
    """Counts and sums per key. Catalyst drops the aggregates, and the scan columns, that no consumer reads."""
    trips = with_keys(enriched, spec)
    return trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count(spec.party).alias("reported_trips"),
        F.count(spec.total).alias("paid_trips"),
        F.count("trip_duration_minutes").alias("timed_trips"),
        F.count(spec.distance).alias("measured_trips"),
        F.count_if(F.col(spec.origin_id) == F.col(spec.dest_id)).alias("same_place_trips"),
        F.count_if(F.col(spec.origin_id) != F.col(spec.dest_id)).alias("other_place_trips"),
        F.sum(spec.party).alias("passengers"),
        exact_parts(trips, spec.fare).alias("fares"),
        exact_parts(trips, spec.total).alias("payments"),
        exact_parts(trips, spec.distance).alias("miles"),
        exact_parts(trips, "trip_duration_minutes").alias("minutes"),
    )


def roll_up(totals: DataFrame, *keys: str) -> DataFrame:
    """The same totals at a coarser grain; without a shuffle when the grain is unchanged."""
    return totals.groupBy(*keys).agg(*(add_parts(totals, c).alias(c) for c in (*COUNTS, *SUMS)))
