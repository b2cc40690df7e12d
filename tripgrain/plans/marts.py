"""The nine reports.

Each takes additive totals (`operators.totals`) at its own grain or finer. `REPORTS` names the coarsest
grain that is enough, which is what a report on its own is given; the refresh hands every report the same
stored totals instead. Denominators differ between the reports and are stated with each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.numeric import as_double, mean, mean_of_parts, percent, ratio, round_to, sum_of_parts, with_values
from tripgrain.operators.joins import null_safe_join, only_row
from tripgrain.operators.rank import first_in, top
from tripgrain.operators.totals import ROUTE, roll_up, trip_totals
from tripgrain.spec import TripSpec

def daily_demand_revenue(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """Per pickup date, unrounded; the party mean is over trips that report a party."""
    days = with_values(roll_up(totals, "pickup_date"))
    return days.select(
        "pickup_date",
        F.col("trips").alias("daily_trip_count"),
        as_double(F.col("fares")).alias("total_metered_fares"),
        as_double(F.col("payments")).alias("total_passenger_amount_paid"),
        F.col("passengers").alias("total_passengers"),
        ratio(F.col("passengers"), F.col("reported_trips")).alias("avg_passenger_amount"),
    )


def zone_performance(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """Per zone *name* and borough: locations that share a name are one row."""
    zones = with_values(roll_up(totals, "pickup_zone", "pickup_borough"))
    return zones.select(
        F.col("trips").alias("total_trip_count"),
        "pickup_zone",
        "pickup_borough",
        round_to(F.col("fares"), 2).alias("total_metered_fares"),
        round_to(F.col("payments")).alias("total_passenger_amount_paid"),
        F.col("passengers").alias("total_passengers"),
        round_to(ratio(F.col("passengers"), F.col("reported_trips")), 2).alias("avg_passenger_per_trip"),
    )


def hourly_demand(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """Per hour of day. Daily means are over the dates on which the hour was observed."""
    date_hours = roll_up(totals, "pickup_date", "pickup_hour")
    total = {c: sum_of_parts(date_hours, c) for c in ("trips", "reported_trips", "passengers", "fares", "payments", "miles", "minutes")}
    return date_hours.groupBy("pickup_hour").agg(
        F.count(F.lit(1)).alias("days_observed"),
        total["trips"].alias("total_trips"),
        round_to(mean(F.col("trips")), 2).alias("avg_daily_trips"),
        total["passengers"].alias("total_reported_passengers"),
        round_to(mean(F.col("passengers")), 2).alias("avg_daily_reported_passengers"),
        round_to(percent(total["reported_trips"], total["trips"]), 2).alias("passenger_count_coverage_pct"),
        round_to(ratio(total["passengers"], total["reported_trips"]), 2).alias("avg_passengers_per_reported_trip"),
        round_to(total["fares"], 2).alias("total_metered_fares"),
        round_to(mean_of_parts(date_hours, "fares"), 2).alias("avg_daily_metered_fares"),
        round_to(total["payments"], 2).alias("total_passenger_amount"),
        round_to(mean_of_parts(date_hours, "payments"), 2).alias("avg_daily_passenger_amount"),
        round_to(ratio(total["payments"], total["trips"]), 2).alias("avg_passenger_amount_per_trip"),
        round_to(ratio(total["miles"], total["trips"]), 2).alias("avg_trip_distance_miles"),
        round_to(ratio(total["minutes"], total["trips"]), 2).alias("avg_trip_duration_minutes"),
    )


def zone_hourly_demand(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """Unrounded detail per date, hour and zone."""
    cells = with_values(roll_up(totals, "pickup_date", "pickup_hour", "pickup_borough", "pickup_zone"))
    return cells.select(
        "pickup_date",
        "pickup_hour",
        F.col("trips").alias("trips_in_hour"),
        "pickup_borough",
        "pickup_zone",
        F.col("passengers").alias("hourly_passenger_count"),
        as_double(F.col("payments")).alias("hourly_passenger_amount"),
        as_double(F.col("miles")).alias("hourly_trip_distance"),
        as_double(F.col("minutes")).alias("hourly_trip_duration_minutes"),
    )


def zone_hourly_performance(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """Per hour of day and zone. Means are over *active* days: dates with a trip in that zone and hour."""
    cells = roll_up(totals, "pickup_date", "pickup_hour", "pickup_borough", "pickup_zone")
    return cells.groupBy(F.col("pickup_hour").alias("pickup_hour_of_the_day"), "pickup_zone", "pickup_borough").agg(
        round_to(mean(F.col("trips"))).alias("avg_trips_per_active_day"),
        round_to(mean(F.col("passengers"))).alias("avg_reported_passengers_per_active_day"),
        round_to(mean_of_parts(cells, "payments")).alias("avg_passenger_amount_per_active_day"),
        round_to(mean_of_parts(cells, "miles")).alias("avg_trip_miles_per_active_day"),
        round_to(mean_of_parts(cells, "minutes")).alias("avg_trip_minutes_per_active_day"),
    )


def route_performance(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """Unrounded totals per pair of zone names and category; the category compares location IDs."""
    routes = with_values(roll_up(totals, "pickup_zone", "dropoff_zone", "route_category"))
    return routes.select(
        "pickup_zone",
        "dropoff_zone",
        F.col("trips").alias("route_total_trips"),
        as_double(F.col("payments")).alias("route_total_amount"),
        as_double(F.col("minutes")).alias("route_total_trip_duration"),
        as_double(F.col("miles")).alias("route_total_trip_distance"),
        "route_category",
    )


def route_analysis(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """Per-trip means of the route totals; a projection, no further aggregate."""
    trips = F.col("route_total_trips")
    return route_performance(totals, spec).select(
        "pickup_zone",
        "dropoff_zone",
        "route_category",
        "route_total_trips",
        round_to(ratio(F.col("route_total_amount"), trips), 2).alias("avg_route_amount"),
        round_to(ratio(F.col("route_total_trip_distance"), trips), 2).alias("avg_route_trip_distance"),
        round_to(ratio(F.col("route_total_trip_duration"), trips)).alias("avg_route_trip_duration"),
    )


def priority_windows(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """The busiest locations by ID and each one's busiest hour, per *calendar* day of the period.

    All three inputs (locations, hours, grand total) are aggregates of one small frame, whose shuffle Spark
    reuses. Ties go to the lower ID and the earlier hour.
    """
    cells = totals.groupBy("origin_id", "pickup_zone", "pickup_hour").agg(F.sum("trips").alias("trips"))
    grand = only_row(cells.agg(F.sum("trips").alias("trips")))
    zones = top(
        cells.groupBy("origin_id", "pickup_zone").agg(F.sum("trips").alias("monthly_trips")),
        spec.priority_zones,
        F.desc("monthly_trips"),
        F.asc_nulls_last("origin_id"),
        F.asc_nulls_last("pickup_zone"),
        rank="zone_rank",
    )
    hours = cells.groupBy("origin_id", "pickup_hour").agg(F.sum("trips").alias("hour_trips"))
    # `zones` holds at most spec.priority_zones rows, so only their hours are ranked. The null-safe join
    # puts no filter on the hours side, which keeps its shuffle the same as that of the zones side.
    listed = null_safe_join(hours, zones, ["origin_id"]).select(
        "zone_rank", "b.origin_id", "pickup_zone", "pickup_hour", "hour_trips", "monthly_trips"
    )
    peaks = first_in(
        listed.where(F.col("origin_id").isNotNull()), ["zone_rank"], F.desc("hour_trips"), F.asc("pickup_hour")
    )
    return peaks.select(
        "zone_rank",
        F.col("origin_id").alias("pickup_location_id"),
        "pickup_zone",
        F.col("pickup_hour").cast("int").alias("peak_hour"),
        round_to(ratio(F.col("hour_trips"), F.lit(spec.calendar_days)), 2).alias("avg_peak_hour_trips_per_calendar_day"),
        "monthly_trips",
        round_to(percent(F.col("monthly_trips"), grand["trips"]), 2).alias("monthly_trip_share_pct"),
    )


def airport_comparison(totals: DataFrame, spec: TripSpec) -> DataFrame:
    """Mutually exclusive origin segments; means are over the trips whose measure is known."""
    segment = F.lit(spec.other_segment)
    for location, label in reversed(spec.segments):
        segment = F.when(F.col("origin_id") == location, label).otherwise(segment)
    segments = with_values(roll_up(totals.withColumn("pickup_segment", segment), "pickup_segment"))
    c = F.col
    return segments.select(
        "pickup_segment",
        c("trips").alias("total_trips"),
        round_to(ratio(c("payments"), c("paid_trips")), 2).alias("avg_recorded_payment_usd"),
        round_to(ratio(c("minutes"), c("timed_trips")), 2).alias("avg_trip_minutes"),
        round_to(ratio(c("miles"), c("measured_trips")), 2).alias("avg_trip_miles"),
        round_to(c("payments"), 2).alias("total_recorded_payment_usd"),
    )


_DATE_HOUR_ZONE = ("pickup_date", "pickup_hour", "pickup_borough", "pickup_zone")

# report name -> (its builder, the coarsest grain of totals that is enough)
REPORTS: dict[str, tuple[Callable[[DataFrame, TripSpec], DataFrame], tuple[str, ...]]] = {
    "daily_demand_revenue": (daily_demand_revenue, ("pickup_date",)),
    "zone_performance": (zone_performance, ("pickup_zone", "pickup_borough")),
    "hourly_demand": (hourly_demand, ("pickup_date", "pickup_hour")),
    "zone_hourly_demand": (zone_hourly_demand, _DATE_HOUR_ZONE),
    "zone_hourly_performance": (zone_hourly_performance, _DATE_HOUR_ZONE),
    "route_performance": (route_performance, ROUTE),
    "route_analysis": (route_analysis, ROUTE),
    "priority_windows": (priority_windows, ("origin_id", "pickup_zone", "pickup_hour")),
    "airport_comparison": (airport_comparison, ("origin_id",)),
}


def mart(name: str, enriched: DataFrame, spec: TripSpec) -> DataFrame:
    """One report straight from the enriched trips, aggregated once at its own grain."""
    build, grain = REPORTS[name]
    return build(trip_totals(enriched, spec, *grain), spec)


def all_marts(place_hours: DataFrame, routes: DataFrame, spec: TripSpec) -> dict[str, DataFrame]:
    """Every report from two stored sets of totals, at the `PLACE_HOUR` and the `ROUTE` grain or finer."""
    return {
        name: build(routes if grain == ROUTE else place_hours, spec) for name, (build, grain) in REPORTS.items()
    }
