"""The findings told in prose, as queries over reports or totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.numeric import percent, ratio, round_to, sum_of_parts
from tripgrain.operators.joins import only_row
from tripgrain.operators.rank import first_in
from tripgrain.operators.staging import VALID
from tripgrain.operators.totals import with_keys
from tripgrain.plans.suites import label_groups, label_metrics
from tripgrain.spec import TripSpec


def borough_share(zones: DataFrame) -> DataFrame:
    """Share of pickups per borough."""
    boroughs = zones.groupBy("pickup_borough").agg(F.sum("total_trip_count").alias("trips"))
    all_trips = only_row(boroughs.agg(F.sum("trips").alias("trips")))
    return boroughs.withColumn("share_pct", round_to(percent(F.col("trips"), all_trips["trips"]), 2))


def missing_share(totals: DataFrame) -> DataFrame:
    """Share of eligible trips that report no party size."""
    trips, reported = F.sum("trips"), F.sum("reported_trips")
    return totals.agg(
        trips.alias("eligible_trips"),
        (trips - reported).alias("missing_passenger_count"),
        round_to(percent(trips - reported, trips), 2).alias("missing_pct"),
    )


def week_over_week(daily: DataFrame) -> DataFrame:
    """Each date against the date seven calendar days earlier, if that one was observed.

    Every date is sent to itself and to the date a week later, where the two meet in one aggregate; a
    self-join would compute the daily report twice.
    """
    now, before = F.col("daily_trip_count"), F.col("trips_week_before")
    nothing = F.lit(None).cast("bigint")
    sent = F.array(
        F.struct("pickup_date", now.alias("daily_trip_count"), nothing.alias("trips_week_before")),
        F.struct(F.date_add("pickup_date", 7).alias("pickup_date"), nothing.alias("daily_trip_count"), now.alias("trips_week_before")),
    )
    met = daily.select(F.inline(sent)).groupBy("pickup_date").agg(
        F.max("daily_trip_count").alias("daily_trip_count"), F.max("trips_week_before").alias("trips_week_before")
    )
    return met.where(now.isNotNull() & before.isNotNull()).withColumn("change_pct", round_to(percent(now - before, before), 2))


def daily_rejections(staged: DataFrame, spec: TripSpec) -> DataFrame:
    """Source and eligible trips per date: does a quiet day come from the cleaning?"""
    return (
        staged.groupBy(F.to_date(spec.pickup_ts).alias("pickup_date"))
        .agg(F.count(F.lit(1)).alias("source_trips"), F.count_if(F.col(VALID)).alias("eligible_trips"))
        .withColumn("rejected_pct", round_to(percent(F.col("source_trips") - F.col("eligible_trips"), F.col("source_trips")), 2))
    )


def hours_per_date(enriched: DataFrame, spec: TripSpec) -> DataFrame:
    """Hours of day with at least one eligible trip, per date."""
    trips = with_keys(enriched, spec)
    return trips.groupBy("pickup_date").agg(F.countDistinct("pickup_hour").alias("hours_observed"))


def zone_peak_active(zone_hours: DataFrame, spec: TripSpec) -> DataFrame:
    """The busiest hour of each watched zone by its active-day mean; the earlier hour wins a tie."""
    watched = zone_hours.where(F.col("pickup_zone").isin(*spec.watched_zones))
    peak = first_in(
        watched,
        ["pickup_zone", "pickup_borough"],
        F.desc("avg_trips_per_active_day"),
        F.asc("pickup_hour_of_the_day"),
    )
    return peak.select("pickup_zone", "pickup_borough", "pickup_hour_of_the_day", "avg_trips_per_active_day")


def hour_leaders(zone_hours: DataFrame) -> DataFrame:
    """The leading zone of each hour."""
    leaders = first_in(
        zone_hours,
        ["pickup_hour_of_the_day"],
        F.desc("avg_trips_per_active_day"),
        F.asc_nulls_last("pickup_zone"),
        F.asc_nulls_last("pickup_borough"),
    )
    return leaders.select("pickup_hour_of_the_day", "pickup_zone", "pickup_borough", "avg_trips_per_active_day")


def segment_vs_all(segments: DataFrame, totals: DataFrame) -> DataFrame:
    """Each segment's means against those of all eligible trips; `totals` may have any grain."""
    overall = only_row(
        totals.agg(
            ratio(sum_of_parts(totals, "payments"), F.sum("paid_trips")).alias("payment"),
            ratio(sum_of_parts(totals, "minutes"), F.sum("timed_trips")).alias("minutes"),
        )
    )
    return segments.withColumn("overall", overall).select(
        "pickup_segment",
        "avg_recorded_payment_usd",
        round_to(F.col("overall.payment"), 2).alias("all_trips_payment_usd"),
        "avg_trip_minutes",
        round_to(F.col("overall.minutes"), 2).alias("all_trips_minutes"),
    )


def hour_extremes(hourly: DataFrame) -> DataFrame:
    """Busiest and quietest hour by daily mean; the earlier hour wins a tie."""
    busy = F.max(F.struct("avg_daily_trips", (-F.col("pickup_hour")).alias("earliness")))
    quiet = F.min(F.struct("avg_daily_trips", "pickup_hour"))
    return hourly.agg(busy.alias("busy"), quiet.alias("quiet")).select(
        (-F.col("busy.earliness")).alias("busiest_hour"),
        F.col("busy.avg_daily_trips").alias("busiest_avg_trips"),
        F.col("quiet.pickup_hour").alias("quietest_hour"),
        F.col("quiet.avg_daily_trips").alias("quietest_avg_trips"),
    )


def coverage_info(enriched: DataFrame, spec: TripSpec) -> DataFrame:
    """Figures worth knowing that are not pass-or-fail checks."""
    return label_metrics(label_groups(enriched, spec), spec).select(
        F.col("trips").alias("eligible_trips"), "outside_zone_trips", F.col("unreported").alias("missing_passenger_count")
    )
