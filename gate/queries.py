"""One query per capability. Every query runs over the whole tables of the given scale."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gate import binding as b
from tripgrain.functions.numeric import as_double, exact_sum
from tripgrain.functions.temporal import micros_between, seconds_between, to_minutes, with_interval_text
from tripgrain.operators.checks import ChecksFailed
from tripgrain.operators.enrich import LABELS, enrich
from tripgrain.operators.joins import null_safe_join
from tripgrain.operators.positions import read_in_order
from tripgrain.operators.staging import VALID, clean_trips
from tripgrain.operators.totals import PLACE_HOUR, ROUTE, trip_totals, with_keys
from tripgrain.plans import insights, profiles, published
from tripgrain.plans.marts import REPORTS, all_marts, mart
from tripgrain.plans.refresh import published_dataset, read_enriched, run_refresh, stored_evidence
from tripgrain.plans.suites import SUITES, Evidence, all_checks, checks_completeness, direct_evidence, gate
from tripgrain.session import durable, run_dir
from tripgrain.sinks import contract_violations, manifest, read_csv_back, verified_evidence, verified_extract, write_csv
from tripgrain.sources import read_lookup
from tripgrain.spec import TripSpec
from tripgrain.views import register_views

Query = Callable[[SparkSession, str], DataFrame]
SPEC, EVENT_SPEC, REFRESH_SPEC = b.SPEC, b.EVENT_SPEC, b.REFRESH_SPEC


# --- stages of the main, the gappy and the event binding -----------------------------------------------


def staged(spark: SparkSession, d: str) -> DataFrame:
    return clean_trips(b.raw_trips(spark, d, SPEC), SPEC)


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return enrich(staged(spark, d), b.lookup(spark, d), SPEC)


def gappy_staged(spark: SparkSession, d: str) -> DataFrame:
    return clean_trips(b.gappy_trips(spark, d, SPEC), SPEC)


def gappy_enriched(spark: SparkSession, d: str) -> DataFrame:
    return enrich(gappy_staged(spark, d), b.short_lookup(spark, d), SPEC)


def event_enriched(spark: SparkSession, d: str) -> DataFrame:
    return enrich(clean_trips(b.event_trips(spark, d), EVENT_SPEC), b.lookup(spark, d), EVENT_SPEC)


def _report(name: str, source: Callable[[SparkSession, str], DataFrame] = enriched, spec: TripSpec = SPEC) -> Query:
    return lambda spark, d: mart(name, source(spark, d), spec)


# --- checks ---------------------------------------------------------------------------------------------


def _evidence(spark: SparkSession, d: str, gappy: bool = False, store: bool = False) -> Evidence:
    """`store` keeps the enriched trips, as the pipeline does; a suite on its own aggregates them where they are."""
    make, places = (b.gappy_trips, b.short_lookup) if gappy else (b.raw_trips, b.lookup)
    trips, lookup = make(spark, d), places(spark, d)  # of all years: the period is the checks' business
    clean = clean_trips(trips, SPEC)
    columns = [*SPEC.trip_columns, "trip_duration_minutes", VALID, *LABELS, "pickup_date"]
    labelled = enrich(clean, lookup, SPEC).select(*columns)
    return direct_evidence(SPEC, trips, clean, lookup, durable(labelled, "enriched") if store else labelled)


def _suite(name: str, gappy: bool = False) -> Query:
    return lambda spark, d: SUITES[name](_evidence(spark, d, gappy))


def _all_check_rows(spark: SparkSession, d: str) -> DataFrame:
    e = _evidence(spark, d, store=True)
    place_hours = durable(trip_totals(e.enriched, SPEC, *PLACE_HOUR), "place-hours")
    routes = durable(trip_totals(e.enriched, SPEC, *ROUTE), "routes")
    marts = all_marts(place_hours, routes, SPEC)
    return all_checks(stored_evidence(SPEC, e.trips, e.staged, e.lookup, e.enriched, marts))


def check_gate(spark: SparkSession, d: str) -> DataFrame:
    return gate(_all_check_rows(spark, d))


# --- published figures ----------------------------------------------------------------------------------


def summary(spark: SparkSession, d: str) -> DataFrame:
    totals = durable(trip_totals(enriched(spark, d), SPEC, "pickup_zone", "pickup_borough"), "zone-totals")
    build, _ = REPORTS["zone_performance"]
    return published.summary(totals, build(totals, SPEC), staged(spark, d), SPEC)


def segment_vs_all(spark: SparkSession, d: str) -> DataFrame:
    build, grain = REPORTS["airport_comparison"]
    totals = durable(trip_totals(enriched(spark, d), SPEC, *grain), "origin-totals")
    return insights.segment_vs_all(build(totals, SPEC), totals)


# --- single operators -----------------------------------------------------------------------------------


def duration_seconds(spark: SparkSession, d: str) -> DataFrame:
    seconds = seconds_between(*_event_pair()).alias("seconds")
    return b.table(spark, d, "events").select("event_id", seconds).withColumn("minutes", to_minutes("seconds"))


def duration_text(spark: SparkSession, d: str) -> DataFrame:
    start, end = _event_pair()
    pairs = b.table(spark, d, "events").select("event_id", start.alias("start"), end.alias("end"))
    text = with_interval_text(pairs, "start", "end", "elapsed")
    return text.select("event_id", micros_between(F.col("start"), F.col("end")).alias("micros"), "elapsed")


def _event_pair():
    """From a fixed moment in mid-stream to each event: both signs, up to two weeks, microseconds."""
    return F.lit("2024-01-16 06:07:08.9").cast("timestamp_ntz"), F.col("ts")


def distinct_tuples(spark: SparkSession, d: str) -> DataFrame:
    """Distinct rows of several columns; a row with nulls is a value like any other.

    The trips are reduced to their distinct labels first; several distinct counts over the trips themselves
    would copy every trip once per count.
    """
    labels = gappy_enriched(spark, d).groupBy("pickup_zone", "pickup_borough", "dropoff_zone").agg(F.count(F.lit(1)))
    return labels.agg(
        F.countDistinct(F.struct("pickup_zone", "pickup_borough", "dropoff_zone")).alias("label_tuples"),
        F.countDistinct(F.struct("pickup_zone")).alias("zones_with_unknown"),
        F.countDistinct("pickup_zone").alias("zones"),
    )


def filtered_sums(spark: SparkSession, d: str) -> DataFrame:
    """Sums of the rows that meet a condition; null where no row does."""
    same = F.col("route_category") == "Same-Zone"
    amount, party = F.col(SPEC.total), F.col(SPEC.party)
    trips = with_keys(gappy_enriched(spark, d), SPEC).withColumns(
        {"same_amount": F.when(same, amount), "cross_amount": F.when(~same, amount), "far_party": F.when(F.col(SPEC.distance) > 40, party)}
    )
    return trips.groupBy("pickup_borough").agg(
        F.count_if(same).alias("same_zone_trips"),
        as_double(exact_sum(trips, "same_amount")).alias("same_zone_amount"),
        as_double(exact_sum(trips, "cross_amount")).alias("cross_zone_amount"),
        F.sum("far_party").alias("far_party"),
    )


def null_safe_match(spark: SparkSession, d: str) -> DataFrame:
    """Pickups against dropoffs per label pair; the unlabelled trips of both sides meet as well."""
    trips = gappy_enriched(spark, d)
    pairs = trips.groupBy(SPEC.dest_id, *LABELS).agg(F.count(F.lit(1)).alias("trips"))
    keys = ["zone", "borough"]
    out = pairs.groupBy(F.col("pickup_zone").alias("zone"), F.col("pickup_borough").alias("borough")).agg(
        F.sum("trips").alias("pickups")
    )
    back = pairs.groupBy(F.col("dropoff_zone").alias("zone"), F.col("dropoff_borough").alias("borough")).agg(
        F.sum("trips").alias("dropoffs"),
        F.sum(F.when(F.col(SPEC.dest_id).isNotNull(), F.col("trips")).otherwise(0)).alias("known_dropoffs"),
    )
    return null_safe_join(out, back, keys).select("a.zone", "a.borough", "pickups", "dropoffs", "known_dropoffs")


def correlated_count(spark: SparkSession, d: str) -> DataFrame:
    """Per location, its trips that start and end there in hour 4; zero where there are none."""
    trips = enriched(spark, d)
    homeward = trips.where((F.col("origin_id") == F.col("dest_id")) & (F.hour("pickup_ts") == 4))
    per_place = homeward.groupBy(F.col("origin_id").alias("location_id")).agg(F.count(F.lit(1)).alias("n"))
    return (
        b.lookup(spark, d)
        .join(per_place, "location_id", "left")
        .select("location_id", "zone", F.coalesce("n", F.lit(0)).alias("trips_in_hour_4"))
    )


def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    """Duplicate keys per column set, as count minus distinct count."""
    trips = enriched(spark, d)
    return trips.groupBy("pickup_zone").agg(
        F.count("l_orderkey").alias("trips"),
        (F.count("l_orderkey") - F.countDistinct("l_orderkey")).alias("repeated_orders"),
        F.min("pickup_ts").alias("first_pickup"),
        F.max("pickup_date").alias("last_date"),
    )


# --- sources, views and sinks ---------------------------------------------------------------------------


def lookup_csv(spark: SparkSession, d: str) -> DataFrame:
    places = b.lookup(spark, d).select("location_id", "borough", "zone", F.lit("N/A").alias("service_zone"))
    return read_lookup(spark, write_csv(places, run_dir(spark, "lookup")), SPEC)


def view_query(spark: SparkSession, d: str) -> DataFrame:
    register_views(b.raw_trips(spark, d, SPEC), b.lookup(spark, d), SPEC)
    return spark.sql(
        "SELECT p.zone_rank, p.pickup_zone, p.peak_hour, z.total_trip_count, z.total_metered_fares "
        "FROM priority_windows p JOIN zone_performance z ON p.pickup_zone = z.pickup_zone ORDER BY p.zone_rank"
    )


def export_csv(spark: SparkSession, d: str) -> DataFrame:
    report = published.ordered(_report("hourly_demand")(spark, d), "hourly_demand")
    return read_csv_back(spark, write_csv(report, run_dir(spark, "hourly-csv")), report.schema)


def export_contract(spark: SparkSession, d: str) -> DataFrame:
    report = _report("route_analysis")(spark, d)
    path = write_csv(report, run_dir(spark, "routes-csv"))
    return contract_violations(spark, path, report.schema)


def extract(spark: SparkSession, d: str) -> DataFrame:
    name = "zone_hourly_performance"
    return verified_extract(_report(name)(spark, d), run_dir(spark, "zone-hours"), published.ORDER[name])


def evidence_json(spark: SparkSession, d: str) -> DataFrame:
    """Summary, check rows and reports as JSON lines, read back: counted, and compared with what was written."""
    e = _evidence(spark, d, store=True)
    place_hours = durable(trip_totals(e.enriched, SPEC, *PLACE_HOUR), "place-hours")
    routes = durable(trip_totals(e.enriched, SPEC, *ROUTE), "routes")
    marts = all_marts(place_hours, routes, SPEC)
    datasets = {
        "summary": published.summary(place_hours, marts["zone_performance"], e.staged, SPEC),
        "quality_checks": all_checks(stored_evidence(SPEC, e.trips, e.staged, e.lookup, e.enriched, marts)),
    }
    datasets.update({name: marts[name] for name in published.ORDER if name in marts})
    return verified_evidence(datasets, run_dir(spark, "evidence"))


# --- the whole refresh ----------------------------------------------------------------------------------

_refreshed: dict[tuple[str, str], str] = {}


def _refresh(spark: SparkSession, d: str) -> str:
    """Where the refresh of these tables has published; it runs once a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _refreshed:
        out = run_dir(spark, "refresh")
        run_refresh(b.raw_trips(spark, d), b.lookup(spark, d), REFRESH_SPEC, out)
        _refreshed[key] = out
    return _refreshed[key]


def refresh_enriched(spark: SparkSession, d: str) -> DataFrame:
    """The enriched trips as published."""
    return read_enriched(spark, _refresh(spark, d), REFRESH_SPEC)


def refresh_reports(spark: SparkSession, d: str) -> DataFrame:
    """A report as published in CSV."""
    path = published_dataset(spark, _refresh(spark, d), "csv/zone_hourly_performance")
    return read_csv_back(spark, path, _report("zone_hourly_performance")(spark, d).schema)


def refresh_stopped(spark: SparkSession, d: str) -> DataFrame:
    """What readers find after a refresh that its checks have stopped: the version before, and no other files."""
    out = _refresh(spark, d)
    try:
        run_refresh(b.gappy_trips(spark, d), b.short_lookup(spark, d), REFRESH_SPEC, out)
        stopped = False
    except ChecksFailed:
        stopped = True
    trips = read_enriched(spark, out, REFRESH_SPEC).agg(F.count(F.lit(1)).alias("eligible_trips"))
    unused = len(manifest.drop_unused(spark, out))
    return trips.withColumns({"version": F.lit(manifest.current(spark, out).number), "stopped": F.lit(stopped), "folders_left": F.lit(unused)})


def published_positions(spark: SparkSession, d: str) -> DataFrame:
    """The rows of published datasets with their place in the files."""
    out = _refresh(spark, d)
    shown = []
    for name in ("daily_demand_revenue", "hourly_demand", "zone_performance", "zone_hourly_performance", "airport_comparison"):
        path = published_dataset(spark, out, f"extract/{name}")
        rows = read_in_order(spark, path, spark.read.parquet(path).schema)
        keys = (F.coalesce(F.col(k.removeprefix("-")).cast("string"), F.lit("-")) for k in published.ORDER[name])
        shown.append(rows.select(F.lit(name).alias("dataset"), "position", F.concat_ws("|", *keys).alias("sort_key")))
    return reduce(DataFrame.unionByName, shown)


QUERIES: dict[str, Query] = {
    # sources and first looks
    "profile_schema": lambda s, d: profiles.profile_schema(b.raw_trips(s, d)),
    "profile_raw": lambda s, d: profiles.profile_raw(b.raw_trips(s, d), SPEC),
    "profile_period": lambda s, d: profiles.profile_period(b.raw_trips(s, d), SPEC),
    "profile_quality": lambda s, d: profiles.profile_quality(b.gappy_trips(s, d), SPEC),
    "lookup_csv": lookup_csv,
    "view_query": view_query,
    # stages
    "staged_trips": staged,
    "staged_gappy": gappy_staged,
    "enriched_trips": enriched,
    "enriched_gappy": gappy_enriched,
    "duration_seconds": duration_seconds,
    "duration_text": duration_text,
    # reports
    "daily_demand": _report("daily_demand_revenue"),
    "zone_performance": _report("zone_performance"),
    "hourly_demand": _report("hourly_demand"),
    "zone_hour_detail": _report("zone_hourly_demand"),
    "zone_hour_performance": _report("zone_hourly_performance"),
    "route_totals": _report("route_performance"),
    "route_averages": _report("route_analysis"),
    "priority_windows": _report("priority_windows"),
    "segment_comparison": _report("airport_comparison"),
    # reports over missing measures, unmatched and shared labels
    "daily_gappy": _report("daily_demand_revenue", gappy_enriched),
    "zone_gappy": _report("zone_performance", gappy_enriched),
    "zone_hour_gappy": _report("zone_hourly_performance", gappy_enriched),
    "route_gappy": _report("route_performance", gappy_enriched),
    "segment_gappy": _report("airport_comparison", gappy_enriched),
    "priority_gappy": _report("priority_windows", gappy_enriched),
    # reports over the event stream's wall-clock times
    "event_daily": _report("daily_demand_revenue", event_enriched, EVENT_SPEC),
    "event_hourly": _report("hourly_demand", event_enriched, EVENT_SPEC),
    "event_priority": _report("priority_windows", event_enriched, EVENT_SPEC),
    # checks
    **{name: _suite(name) for name in SUITES},
    "checks_enriched_gappy": _suite("checks_enriched", gappy=True),
    "checks_routes_gappy": _suite("checks_routes", gappy=True),
    "checks_completeness": lambda s, d: checks_completeness(_evidence(s, d)),
    "checks_completeness_gappy": lambda s, d: checks_completeness(_evidence(s, d, gappy=True)),
    "check_gate": check_gate,
    # published figures
    "summary": summary,
    "priority_table": lambda s, d: published.priority_table(_report("priority_windows")(s, d)),
    "segment_table": lambda s, d: published.airport_table(_report("airport_comparison")(s, d), SPEC),
    "daily_line": lambda s, d: published.daily_line(_report("daily_demand_revenue")(s, d)),
    "hour_bars": lambda s, d: published.hour_bars(_report("hourly_demand")(s, d)),
    "zone_hour_heatmap": lambda s, d: published.zone_hour_heatmap(_report("zone_hourly_performance")(s, d), SPEC),
    "top_zones": lambda s, d: published.top_zones(_report("zone_performance")(s, d), SPEC),
    # findings
    "borough_share": lambda s, d: insights.borough_share(_report("zone_performance")(s, d)),
    "missing_share": lambda s, d: insights.missing_share(trip_totals(enriched(s, d), SPEC, "pickup_borough")),
    "week_over_week": lambda s, d: insights.week_over_week(_report("daily_demand_revenue")(s, d)),
    "daily_rejections": lambda s, d: insights.daily_rejections(staged(s, d), SPEC),
    "hours_per_date": lambda s, d: insights.hours_per_date(enriched(s, d), SPEC),
    "zone_peak_active": lambda s, d: insights.zone_peak_active(_report("zone_hourly_performance")(s, d), SPEC),
    "hour_leaders": lambda s, d: insights.hour_leaders(_report("zone_hourly_performance")(s, d)),
    "segment_vs_all": segment_vs_all,
    "hour_extremes": lambda s, d: insights.hour_extremes(_report("hourly_demand")(s, d)),
    "coverage_info": lambda s, d: insights.coverage_info(gappy_enriched(s, d), SPEC),
    # single operators
    "distinct_tuples": distinct_tuples,
    "distinct_counts": distinct_counts,
    "filtered_sums": filtered_sums,
    "null_safe_join": null_safe_match,
    "correlated_count": correlated_count,
    # sinks
    "export_csv": export_csv,
    "evidence_json": evidence_json,
    "verified_extract": extract,
    "export_contract": export_contract,
    # the whole refresh
    "refresh_enriched": refresh_enriched,
    "refresh_reports": refresh_reports,
    "refresh_stopped": refresh_stopped,
    "published_positions": published_positions,
}
