"""Every check passes on sound data, and turns to FAIL on the damage it exists for."""

from dataclasses import replace

import pytest
from conftest import WEEK, trip
from pyspark.sql import functions as F

from tripgrain.operators.checks import ChecksFailed, enforce
from tripgrain.operators.enrich import enrich
from tripgrain.operators.staging import clean_trips
from tripgrain.operators.totals import trip_totals
from tripgrain.plans import marts as marts_module
from tripgrain.plans.marts import REPORTS, mart
from tripgrain.plans.suites import SUITES, Evidence, all_checks, checks_completeness, direct_evidence, expected_totals, gate
from tripgrain.spec import TripSpec

# The published names of the checks, for the default period, cap and ranking length.
NAMES = {
    "checks_staging": [
        "Staging rows match raw January rows",
        "Valid plus invalid rows match staging rows",
        "Rows with null validity classification",
        "Staging rows outside January",
        "Valid rows with nonpositive duration",
        "Valid rows with nonpositive distance",
        "Valid rows with distance above 500 miles",
        "Valid rows with invalid amount",
        "Invalid rows without a quality flag",
    ],
    "checks_presentation": [
        "Airport segments preserve all eligible trips",
        "Airport payments reconcile",
        "Exactly five priority zones",
        "Priority zone IDs are unique",
        "January has the expected calendar span",
        "Peak averages use all 31 days",
    ],
}


@pytest.fixture(scope="module")
def sound(trips_of, places, week_rows):
    trips = trips_of(week_rows).cache()
    staged = clean_trips(trips, WEEK).cache()
    enriched = enrich(staged, places, WEEK).cache()
    marts = {name: mart(name, enriched, WEEK).cache() for name in REPORTS}
    return Evidence(WEEK, trips, staged, places, enriched, marts, lambda grain: expected_totals(enriched, WEEK, *grain))


def changed(e, **parts):
    marts = {**e.marts, **parts.pop("marts", {})}
    return Evidence(**{**e.__dict__, "marts": marts, **parts})


def failed(suite, evidence):
    return [r.check_order for r in SUITES[suite](evidence).where("check_status <> 'PASS'").orderBy("check_order").collect()]


def damage(e, report, column, change):
    """One row of a report altered."""
    rows = e.marts[report]
    keys = [c for c in rows.columns if rows.schema[c].dataType.typeName() in ("string", "date", "long", "integer") and c != column]
    first = rows.where(F.col(column).isNotNull()).orderBy(*keys).limit(1).withColumn("hit", F.lit(True)).select(*keys, "hit")
    altered = rows.alias("r").join(first.alias("f"), on=[F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys], how="left")
    value = F.when(F.col("f.hit"), change(F.col(f"r.{column}"))).otherwise(F.col(f"r.{column}"))
    kind = rows.schema[column].dataType
    return {report: altered.select(*(value.cast(kind).alias(c) if c == column else F.col(f"r.{c}") for c in rows.columns))}


def without_one(rows):
    return rows.exceptAll(rows.limit(1))


def with_one_twice(rows):
    return rows.unionAll(rows.limit(1))


@pytest.mark.parametrize("suite", list(SUITES))
def test_sound_data_passes(sound, suite):
    rows = SUITES[suite](sound).collect()
    assert [r.check_order for r in rows] == list(range(1, len(rows) + 1))
    assert {r.check_status for r in rows} == {"PASS"}, [r for r in rows if r.check_status != "PASS"]
    assert {r.suite for r in rows} == {suite.removeprefix("checks_")}


def test_there_are_66_checks_and_the_gate_counts_them(sound):
    verdict = gate(all_checks(sound)).first()
    assert (verdict.checks_run, verdict.checks_failed, verdict.verdict) == (66, 0, "PASS")


def test_names_follow_the_spec(sound):
    default = TripSpec()
    e = changed(sound, spec=replace(default, period_start=WEEK.period_start, period_end=default.period_end))
    assert [r.check_name for r in SUITES["checks_staging"](e).collect()] == NAMES["checks_staging"]
    e = changed(sound, spec=default)
    assert [r.check_name for r in SUITES["checks_presentation"](e).collect()] == NAMES["checks_presentation"]


def test_enforce_names_the_failures(sound):
    broken = changed(sound, marts={"daily_demand_revenue": without_one(sound.marts["daily_demand_revenue"])})
    enforce(SUITES["checks_daily"](sound))
    with pytest.raises(ChecksFailed, match="Daily trip counts reconcile"):
        enforce(SUITES["checks_daily"](broken))


# --- staging and enrichment ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "column, value, checks",
    [
        ("is_valid_completed_trip", "cast(null as boolean)", [2, 3]),
        ("tpep_pickup_datetime", "cast(null as timestamp_ntz)", [4]),
        ("has_nonpositive_duration", "true", [5]),
        ("has_nonpositive_distance", "true", [6]),
        ("has_excessive_distance", "true", [7]),
        ("has_invalid_amount", "true", [8]),
        ("is_valid_completed_trip", "false", [9]),
    ],
)
def test_damaged_staging(sound, column, value, checks):
    hit = "is_valid_completed_trip AND PULocationID = 1"
    staged = sound.staged.withColumn(column, F.expr(f"CASE WHEN {hit} THEN {value} ELSE {column} END"))
    assert failed("checks_staging", changed(sound, staged=staged)) == checks


def test_lost_staging_rows(sound):
    assert failed("checks_staging", changed(sound, staged=without_one(sound.staged))) == [1]


@pytest.mark.parametrize(
    "column, value, checks",
    [
        ("tpep_pickup_datetime", "timestamp_ntz'2025-12-31 10:00:00'", [2]),
        ("is_valid_completed_trip", "false", [3]),
        ("trip_distance", "cast(null as double)", [4]),
        ("trip_distance", "500.5D", [4]),
        ("tpep_dropoff_datetime", "tpep_pickup_datetime", [5]),
        ("fare_amount", "-1D", [6]),
        ("pickup_zone", "cast(null as string)", [7, 10]),
        ("dropoff_zone", "cast(null as string)", [8, 11]),
        ("pickup_borough", "'Elsewhere'", [10]),
        ("dropoff_borough", "'Elsewhere'", [11]),
    ],
)
def test_damaged_enrichment(sound, column, value, checks):
    enriched = sound.enriched.withColumn(column, F.expr(f"CASE WHEN PULocationID = 1 THEN {value} ELSE {column} END"))
    assert failed("checks_enriched", changed(sound, enriched=enriched)) == checks


def test_repeated_lookup_id_is_seen_as_fan_out(sound, places):
    twice = places.unionAll(places.where("LocationID = 1"))
    e = changed(sound, lookup=twice, enriched=enrich(sound.staged, twice, WEEK))
    assert failed("checks_enriched", e) == [1, 9]


def test_location_without_lookup_row(trips_of, places):
    staged = clean_trips(trips_of([trip(origin=99, dest=1), trip(origin=1, dest=98)]), WEEK)
    enriched = enrich(staged, places, WEEK)
    e = Evidence(WEEK, staged, staged, places, enriched, {}, lambda grain: expected_totals(enriched, WEEK, *grain))
    assert failed("checks_enriched", e) == [7, 8, 10, 11]


# --- reports -------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "suite, report, column, change, checks",
    [
        ("checks_daily", "daily_demand_revenue", "daily_trip_count", lambda c: c + 1, [1]),
        ("checks_daily", "daily_demand_revenue", "total_metered_fares", lambda c: c + 0.02, [2]),
        ("checks_daily", "daily_demand_revenue", "total_passenger_amount_paid", lambda c: c - 0.02, [3]),
        ("checks_daily", "daily_demand_revenue", "total_passengers", lambda c: c + 1, [4]),
        ("checks_daily", "daily_demand_revenue", "avg_passenger_amount", lambda c: c + 0.00001, [7]),
        ("checks_daily", "daily_demand_revenue", "avg_passenger_amount", lambda c: F.lit(None), [7]),
        ("checks_daily", "daily_demand_revenue", "avg_passenger_amount", lambda c: c + 0.0000001, []),
        ("checks_zones", "zone_performance", "total_trip_count", lambda c: c - 1, [1]),
        ("checks_zones", "zone_performance", "total_metered_fares", lambda c: c + 0.5, [2]),
        ("checks_zones", "zone_performance", "total_metered_fares", lambda c: c + 0.01, []),
        ("checks_zones", "zone_performance", "total_passenger_amount_paid", lambda c: c + 9, [3]),
        ("checks_zones", "zone_performance", "total_passengers", lambda c: c + 1, [4]),
        ("checks_zones", "zone_performance", "avg_passenger_per_trip", lambda c: c + 0.01, [7]),
        ("checks_hourly", "hourly_demand", "total_trips", lambda c: c + 1, [1]),
        ("checks_hourly", "hourly_demand", "total_reported_passengers", lambda c: c + 1, [2]),
        ("checks_hourly", "hourly_demand", "total_metered_fares", lambda c: c + 1, [3]),
        ("checks_hourly", "hourly_demand", "total_passenger_amount", lambda c: c + 1, [4]),
        ("checks_hourly", "hourly_demand", "days_observed", lambda c: c + 1, [7]),
        ("checks_hourly", "hourly_demand", "avg_daily_trips", lambda c: c + 0.01, [7]),
        ("checks_hourly", "hourly_demand", "passenger_count_coverage_pct", lambda c: c + 0.01, [7]),
        ("checks_hourly", "hourly_demand", "avg_passenger_amount_per_trip", lambda c: c + 0.01, [7]),
        ("checks_hourly", "hourly_demand", "avg_trip_distance_miles", lambda c: c + 0.01, [7]),
        ("checks_hourly", "hourly_demand", "avg_trip_duration_minutes", lambda c: F.lit(None), [7]),
        ("checks_zone_hourly", "zone_hourly_demand", "trips_in_hour", lambda c: c + 20, [1, 9]),
        ("checks_zone_hourly", "zone_hourly_demand", "hourly_passenger_count", lambda c: c + 20, [2, 9]),
        ("checks_zone_hourly", "zone_hourly_demand", "hourly_passenger_amount", lambda c: c + 0.02, [3]),
        ("checks_zone_hourly", "zone_hourly_demand", "hourly_trip_distance", lambda c: c + 0.02, [4]),
        ("checks_zone_hourly", "zone_hourly_demand", "hourly_trip_duration_minutes", lambda c: c + 0.02, [5]),
        ("checks_zone_hourly", "zone_hourly_performance", "avg_trips_per_active_day", lambda c: c + 1, [9]),
        ("checks_zone_hourly", "zone_hourly_performance", "avg_reported_passengers_per_active_day", lambda c: F.lit(None), [9]),
        ("checks_zone_hourly", "zone_hourly_performance", "avg_trip_minutes_per_active_day", lambda c: c + 1, [9]),
        ("checks_routes", "route_performance", "route_total_amount", lambda c: c + 0.02, [2, 10]),
        ("checks_routes", "route_performance", "route_total_trip_distance", lambda c: c + 0.02, [3, 10]),
        ("checks_routes", "route_performance", "route_total_trip_duration", lambda c: c + 0.02, [4]),
        ("checks_routes", "route_analysis", "avg_route_amount", lambda c: c + 0.011, [10]),
        ("checks_routes", "route_analysis", "avg_route_trip_duration", lambda c: c + 1.1, [10]),
        ("checks_presentation", "airport_comparison", "total_trips", lambda c: c + 1, [1]),
        ("checks_presentation", "airport_comparison", "total_recorded_payment_usd", lambda c: c + 0.05, [2]),
        ("checks_presentation", "priority_windows", "avg_peak_hour_trips_per_calendar_day", lambda c: c + 0.02, [6]),
    ],
)
def test_altered_value(sound, suite, report, column, change, checks):
    assert failed(suite, changed(sound, marts=damage(sound, report, column, change))) == checks


@pytest.mark.parametrize(
    "suite, report, lost, repeated",
    [
        ("checks_daily", "daily_demand_revenue", {1, 2, 3, 5}, {1, 2, 3, 5, 6}),
        ("checks_zones", "zone_performance", {1, 2, 3, 5}, {1, 2, 3, 5, 6}),
        ("checks_hourly", "hourly_demand", {1, 3, 4, 5}, {1, 3, 4, 5, 6}),
        ("checks_zone_hourly", "zone_hourly_demand", {1, 3, 4, 5}, {1, 3, 4, 5, 6}),
        ("checks_zone_hourly", "zone_hourly_performance", {7}, {7, 8}),
        ("checks_routes", "route_performance", {1, 2, 3, 4, 8}, {1, 2, 3, 4, 8, 9}),
        ("checks_presentation", "airport_comparison", {1, 2}, {1, 2}),
        ("checks_presentation", "priority_windows", {3, 4}, {3}),
    ],
)
def test_lost_and_repeated_rows(sound, suite, report, lost, repeated):
    rows = sound.marts[report]
    assert lost <= set(failed(suite, changed(sound, marts={report: without_one(rows)})))
    assert repeated <= set(failed(suite, changed(sound, marts={report: with_one_twice(rows)})))


def test_category_by_name_instead_of_id(sound):
    """Routes classified by zone name would count trips between two Corona locations as same-zone."""
    wrong = sound.marts["route_performance"].withColumn(
        "route_category", F.when(F.col("pickup_zone").eqNullSafe(F.col("dropoff_zone")), "Same-Zone").otherwise("Cross-Zone")
    )
    assert {5, 6} <= set(failed("checks_routes", changed(sound, marts={"route_performance": wrong})))


def test_unknown_category_breaks_the_partition(sound):
    lost = sound.marts["route_performance"].withColumn("route_category", F.lit("Other"))
    assert {5, 6, 7} <= set(failed("checks_routes", changed(sound, marts={"route_performance": lost})))


def test_short_calendar(sound):
    longer = replace(WEEK, period_end=WEEK.period_end.replace(day=20))
    assert 5 in failed("checks_presentation", changed(sound, spec=longer))


def test_no_trips_at_all_fails_rather_than_passes(trips_of, places):
    staged = clean_trips(trips_of([]), WEEK)
    enriched = enrich(staged, places, WEEK)
    marts = {name: mart(name, enriched, WEEK) for name in REPORTS}
    e = Evidence(WEEK, staged, staged, places, enriched, marts, lambda grain: expected_totals(enriched, WEEK, *grain))
    assert gate(all_checks(e)).first().verdict == "FAIL"


# --- completeness, beside the 66 checks ----------------------------------------------------------------


def test_sound_reports_are_complete(sound):
    rows = checks_completeness(sound).collect()
    assert len(rows) == 6 and {r.check_status for r in rows} == {"PASS"}


@pytest.mark.parametrize(
    "suite, report, column, order",
    [
        ("checks_zones", "zone_performance", "pickup_zone", 2),
        ("checks_zone_hourly", "zone_hourly_performance", "pickup_zone", 5),
        ("checks_daily", "daily_demand_revenue", "pickup_date", 1),
    ],
)
def test_a_group_under_another_key_fails_completeness_alone(sound, suite, report, column, order):
    """The number of rows and all totals stay as they were; the formula checks skip a group that one side doesn't know."""
    first = sound.marts[report].select(F.min(column)).first()[0]
    other = F.lit("Nowhere") if column == "pickup_zone" else F.lit("2025-01-01").cast("date")
    renamed = F.when(F.col(column) == F.lit(first), other).otherwise(F.col(column))
    e = changed(sound, marts={report: sound.marts[report].withColumn(column, renamed)})
    assert failed(suite, e) == []
    rows = {r.check_order: r.actual_value for r in checks_completeness(e).where("check_status = 'FAIL'").collect()}
    assert set(rows) == {order} and rows[order] >= 2


def test_a_dropped_group_fails_completeness(sound):
    e = changed(sound, marts={"route_analysis": without_one(sound.marts["route_analysis"])})
    assert [(r.check_order, r.actual_value) for r in checks_completeness(e).where("check_status = 'FAIL'").collect()] == [(6, 1.0)]


# --- faults in the totals behind the reports ------------------------------------------------------------

FAULTS = {
    "a location is dropped": lambda t, keys: t,
    "payments doubled": lambda t, keys: t.withColumn("payments", 2 * F.col("payments")),
    "fares doubled": lambda t, keys: t.withColumn("fares", 2 * F.col("fares")),
    "passengers lost": lambda t, keys: t.withColumn("passengers", F.col("passengers") - 1),
    "a key is lost": lambda t, keys: t.where(F.col(keys[0]) != t.agg(F.min(keys[0])).first()[0]),
}


@pytest.mark.parametrize("fault", FAULTS)
def test_a_fault_in_the_report_totals_fails_the_gate(sound, monkeypatch, fault):
    """The expected side shares no code with the reports, so it does not make the same mistake."""

    def broken(enriched, spec, *keys):
        if fault == "a location is dropped":
            enriched = enriched.where(F.col(spec.origin_id) != 3)
        return FAULTS[fault](trip_totals(enriched, spec, *keys), keys)

    monkeypatch.setattr(marts_module, "trip_totals", broken)
    evidence = direct_evidence(WEEK, sound.trips, sound.staged, sound.lookup, sound.enriched)
    wrong = all_checks(evidence).where("check_status <> 'PASS'")
    assert gate(all_checks(evidence)).first().verdict == "FAIL"
    suites = {r.suite for r in wrong.select("suite").distinct().collect()}
    if fault in ("a location is dropped", "payments doubled"):
        assert {"daily", "zones", "hourly", "zone_hourly", "routes", "presentation"} <= suites


def test_expected_and_reported_totals_share_no_shuffle(sound):
    evidence = direct_evidence(WEEK, sound.trips, sound.staged, sound.lookup, sound.enriched)
    plan = SUITES["checks_daily"](evidence)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "ReusedExchange" in line and "BroadcastExchange" not in line]  # the lookup may be shared
