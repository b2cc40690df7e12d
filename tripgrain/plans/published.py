"""The figures, tables and chart datasets shown to readers, all derived from the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.numeric import as_double, percent, ratio, sum_of_parts
from tripgrain.operators.joins import only_row
from tripgrain.operators.rank import top
from tripgrain.spec import TripSpec

# Published datasets and the order of their rows. Sorting belongs to the sink, not to the report.
ORDER: dict[str, tuple[str, ...]] = {
    "daily_demand_revenue": ("pickup_date",),
    "hourly_demand": ("pickup_hour",),
    "zone_performance": ("-total_trip_count", "pickup_zone", "pickup_borough"),
    "zone_hourly_performance": ("pickup_zone", "pickup_hour_of_the_day", "pickup_borough"),
    "priority_windows": ("zone_rank",),
    "airport_comparison": ("pickup_segment",),
    "priority_table": ("Priority_zone",),
    "airport_table": ("Pickup_area",),
}


def ordered(df: DataFrame, name: str) -> DataFrame:
    """The dataset in its published order, nulls last either way."""
    keys = (
        F.desc_nulls_last(key[1:]) if key.startswith("-") else F.asc_nulls_last(key) for key in ORDER[name]
    )
    return df.orderBy(*keys)


def summary(totals: DataFrame, zones: DataFrame, staged: DataFrame, spec: TripSpec) -> DataFrame:
    """The headline figures in one row; `totals` may have any grain."""
    leaders = top(
        zones.select("total_trip_count", "pickup_zone", "pickup_borough"),
        spec.leading_zones,
        F.desc("total_trip_count"),
        F.asc_nulls_last("pickup_zone"),
        F.asc_nulls_last("pickup_borough"),
    )
    facts = totals.agg(
        *(sum_of_parts(totals, c).alias(c) for c in ("trips", "reported_trips", "paid_trips", "timed_trips", "payments", "minutes"))
    ).withColumns(
        {
            "leaders": only_row(leaders.agg(F.sum("total_trip_count").alias("trips"))),
            "staged": only_row(staged.agg(F.count(F.lit(1)).alias("trips"))),
        }
    )
    c = F.col
    return facts.select(
        F.coalesce(c("trips"), F.lit(0)).alias("eligible_trips"),
        as_double(c("payments")).alias("recorded_payments"),
        ratio(c("payments"), c("paid_trips")).alias("avg_payment"),
        ratio(c("minutes"), c("timed_trips")).alias("avg_minutes"),
        F.coalesce(c("trips") - c("reported_trips"), F.lit(0)).alias("missing_passenger_count"),
        c("staged.trips").alias(f"{spec.period_key}_source_trips"),
        percent(c("leaders.trips"), c("trips")).alias(f"top{spec.leading_zones}_share_pct"),
    )


def _fixed(c: Column, places: int, grouped: bool = True) -> Column:
    """Text with a fixed number of decimals, halves to even on the stored value."""
    text = F.format_number(c, places)
    return text if grouped else F.regexp_replace(text, ",", "")


def priority_table(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.concat_ws(". ", F.col("zone_rank").cast("string"), F.coalesce("pickup_zone", F.lit("None"))).alias(
            "Priority_zone"
        ),
        F.concat(F.lpad(F.col("peak_hour").cast("string"), 2, "0"), F.lit(":00")).alias("Peak_hour"),
        _fixed(F.col("avg_peak_hour_trips_per_calendar_day"), 1).alias("Pickups_per_day_in_peak_hour"),
        F.concat(_fixed(F.col("monthly_trip_share_pct"), 2, grouped=False), F.lit("%")).alias("Monthly_trip_share"),
        F.lit("").alias("Label"),
    )


def airport_table(segments: DataFrame, spec: TripSpec) -> DataFrame:
    return segments.select(
        F.col("pickup_segment").alias("Pickup_area"),
        F.format_number("total_trips", 0).alias(f"{spec.period_name}_trips"),
        F.concat(F.lit("$"), _fixed(F.col("avg_recorded_payment_usd"), 2)).alias("Payment_per_trip_USD"),
        _fixed(F.col("avg_trip_minutes"), 1, grouped=False).alias("Minutes_per_trip"),
        F.lit("").alias("Label"),
    )


def daily_line(daily: DataFrame) -> DataFrame:
    return daily.groupBy("pickup_date").agg(F.sum("daily_trip_count").alias("daily_trip_count"))


def hour_bars(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("pickup_hour").agg(F.sum("avg_daily_trips").alias("avg_daily_trips"))


def zone_hour_heatmap(zone_hours: DataFrame, spec: TripSpec) -> DataFrame:
    """Watched zones by hour of day. The pivot values are given, so Spark does not scan for them first."""
    watched = zone_hours.where(F.col("pickup_zone").isin(*spec.watched_zones))
    grid = (
        watched.groupBy("pickup_zone")
        .pivot("pickup_hour_of_the_day", list(range(24)))
        .agg(F.max("avg_trips_per_active_day"))
    )
    return grid.select("pickup_zone", *(F.col(str(hour)).alias(f"h{hour:02d}") for hour in range(24)))


def top_zones(zones: DataFrame, spec: TripSpec) -> DataFrame:
    """The leading zone names by trips; names shared by several boroughs are one bar."""
    bars = zones.groupBy("pickup_zone").agg(F.sum("total_trip_count").alias("total_trip_count"))
    return top(bars, spec.leading_zones, F.desc("total_trip_count"), F.asc_nulls_last("pickup_zone"))
