"""First looks at raw trips, before any rule is applied. Each is one aggregate over the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.numeric import exact_sum, ratio, round_to
from tripgrain.operators.staging import in_period, wall_clock
from tripgrain.spec import TripSpec


def profile_schema(trips: DataFrame) -> DataFrame:
    """Column, type and number of nulls, all counted in one pass over the data."""
    nulls = trips.agg(F.count(F.lit(1)).alias("row_count"), *(F.count(c).alias(c) for c in trips.columns))
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            (F.col("row_count") - F.col(name)).alias("null_count"),
        )
        for name, kind in trips.dtypes
    ]
    return nulls.select(F.inline(F.array(*rows)))


def profile_raw(trips: DataFrame, spec: TripSpec) -> DataFrame:
    return trips.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.min(spec.pickup_ts).alias("earliest_pickup"),
        F.max(spec.pickup_ts).alias("latest_pickup"),
        round_to(ratio(exact_sum(trips, spec.distance), F.count(spec.distance)), 2).alias("avg_trip_distance"),
        round_to(ratio(exact_sum(trips, spec.total), F.count(spec.total)), 2).alias("avg_amount"),
    )


def profile_period(trips: DataFrame, spec: TripSpec) -> DataFrame:
    """Trips before, in and after the period; a missing pickup is in none of the three."""
    pickup = F.col(spec.pickup_ts)
    return trips.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(pickup < wall_clock(spec.period_start)).alias(f"trips_before_{spec.period_key}"),
        F.count_if(pickup >= wall_clock(spec.period_end)).alias(f"trips_after_{spec.period_key}"),
        F.count_if(in_period(spec)).alias(f"valid_{spec.period_key}_trips"),
    )


def profile_quality(trips: DataFrame, spec: TripSpec) -> DataFrame:
    """How often each raw column is missing or implausible. A total of zero is not counted here."""
    pickup, dropoff = F.col(spec.pickup_ts), F.col(spec.dropoff_ts)
    cases = {
        "no_pickup_count": pickup.isNull(),
        "no_dropoff_count": dropoff.isNull(),
        "zero_trip_duration_count": dropoff == pickup,
        "negative_trip_duration_count": dropoff < pickup,
        "trip_dist_0_or_neg_count": F.col(spec.distance) <= 0,
        "negative_fare_count": F.col(spec.fare) < 0,
        "neg_total_amount_count": F.col(spec.total) < 0,
        f"no_{'pickupLocationID' if spec.origin_id == 'PULocationID' else spec.origin_id}_count": F.col(
            spec.origin_id
        ).isNull(),
        f"no_{spec.dest_id}_count": F.col(spec.dest_id).isNull(),
    }
    return trips.agg(
        F.count(F.lit(1)).alias("total_rows"), *(F.count_if(case).alias(name) for name, case in cases.items())
    )
