"""The eight check suites, 66 checks.

Expected values come neither from the report under test nor from the functions that build it: `expected_totals`
aggregates the columns of the enriched trips on its own, at the coarsest grain that answers all checks of a suite.
Totals, group counts and per-key formulas are taken from that one small frame; the refresh lets five suites share a
stored one. A fault in the totals behind a report therefore shows as a difference.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.logic import all_of, any_of, differs, is_false, is_not_true, is_true, known
from tripgrain.functions.numeric import add_parts, exact_parts, exact_sum, ratio, round_to, sum_of_parts, with_values
from tripgrain.operators.checks import (
    check_rows,
    equal,
    far,
    far_or_one_sided,
    none_of,
    one_row_per,
    parts_make_whole,
    reconciles,
    reconciles_rounded,
    spans,
    unique,
)
from tripgrain.operators.enrich import LABELS, label_side
from tripgrain.operators.joins import null_safe_join, only_row
from tripgrain.operators.staging import FLAGS, VALID, in_period, wall_clock
from tripgrain.operators.totals import ROUTE
from tripgrain.plans.marts import REPORTS, mart
from tripgrain.session import durable
from tripgrain.sources.lookup import bounded
from tripgrain.spec import CROSS_ZONE, SAME_ZONE, TripSpec


@dataclass(frozen=True)
class Evidence:
    """What the suites look at: the data of every stage and the reports under test.

    `totals(grain)` gives an aggregate of the enriched trips at that grain or finer. `keep` stores a small
    frame that has several consumers, which would otherwise each compute their own columns of it.
    """

    spec: TripSpec
    trips: DataFrame
    staged: DataFrame
    lookup: DataFrame
    enriched: DataFrame
    marts: Mapping[str, DataFrame]
    totals: Callable[[tuple[str, ...]], DataFrame]
    keep: Callable[[DataFrame, str], DataFrame] = durable
    raw_rows: int | None = None  # raw trips of the period, where the pass that read them has counted them


class LazyMarts(Mapping):
    """Reports built when a suite asks for them."""

    def __init__(self, enriched: DataFrame, spec: TripSpec):
        self.enriched, self.spec = enriched, spec

    def __getitem__(self, name: str) -> DataFrame:
        return mart(name, self.enriched, self.spec)

    def __iter__(self):
        return iter(REPORTS)

    def __len__(self):
        return len(REPORTS)


def direct_evidence(
    spec: TripSpec, trips: DataFrame, staged: DataFrame, lookup: DataFrame, enriched: DataFrame
) -> Evidence:
    """Evidence for one suite on its own: reports and totals aggregated straight from the enriched trips."""
    return Evidence(
        spec,
        trips,
        staged,
        lookup,
        enriched,
        LazyMarts(enriched, spec),
        lambda grain: expected_totals(enriched, spec, *grain),
    )


def expected_totals(enriched: DataFrame, spec: TripSpec, *keys: str) -> DataFrame:
    """Counts and sums per key, written out on the trips' own columns; shares no code with the reports' totals."""
    same = f"`{spec.origin_id}` = `{spec.dest_id}`"
    derived = {
        "pickup_hour": f"cast(extract(HOUR FROM `{spec.pickup_ts}`) AS bigint)",
        "origin_id": f"`{spec.origin_id}`",
        "route_category": f"CASE WHEN {same} THEN '{SAME_ZONE}' ELSE '{CROSS_ZONE}' END",
    }
    named = [F.expr(derived.get(k, f"`{k}`")).alias(k) for k in keys]
    sums = {"fares": spec.fare, "payments": spec.total, "miles": spec.distance, "minutes": "trip_duration_minutes"}
    return enriched.groupBy(*named).agg(
        F.expr("count(*)").alias("trips"),
        F.expr(f"count(`{spec.party}`)").alias("reported_trips"),
        F.expr(f"sum(`{spec.party}`)").alias("passengers"),
        F.expr(f"count(CASE WHEN {same} THEN 1 END)").alias("same_place_trips"),
        F.expr(f"count(CASE WHEN `{spec.origin_id}` <> `{spec.dest_id}` THEN 1 END)").alias("other_place_trips"),
        *(exact_parts(enriched, c).alias(name) for name, c in sums.items()),
    )


def regrouped(totals: DataFrame, *keys: str) -> DataFrame:
    """Expected totals at a coarser grain."""
    return totals.groupBy(*keys).agg(*(add_parts(totals, c).alias(c) for c in totals.columns if c not in (*keys, *DIMENSIONS)))


# Whatever a grain of expected totals may hold; all other columns add up.
DIMENSIONS = (
    "pickup_date", "pickup_hour", "origin_id", "pickup_zone", "pickup_borough", "dropoff_zone", "route_category",
)


def _count(c: str) -> Column:
    """A sum of counts, zero over no rows at all."""
    return F.coalesce(F.sum(c), F.lit(0)).alias(c)


def _rows(*keys: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(F.struct(*keys) if len(keys) > 1 else F.col(keys[0])).alias("keys"),
    ]


def checks_staging(e: Evidence) -> DataFrame:
    spec = e.spec
    # a missing pickup counts as outside: such a row must not be staged at all
    outside = ~known(in_period(spec))
    valid, invalid = is_true(F.col(VALID)), is_false(F.col(VALID))
    counts = e.staged.agg(
        F.count(F.lit(1)).alias("staged"),
        F.count_if(valid).alias("valid"),
        F.count_if(invalid).alias("invalid"),
        F.count_if(F.col(VALID).isNull()).alias("unclassified"),
        F.count_if(outside).alias("outside"),
        *(F.count_if(valid & is_true(F.col(flag))).alias(flag) for flag in FLAGS),
        F.count_if(invalid & all_of(*(is_not_true(F.col(flag)) for flag in FLAGS))).alias("unexplained"),
    )
    if e.raw_rows is None:
        raw = only_row(e.trips.where(in_period(spec)).agg(F.count(F.lit(1)).alias("rows")))
    else:
        raw = F.struct(F.lit(e.raw_rows).cast("bigint").alias("rows"))
    metrics = counts.withColumn("raw", raw)
    c = F.col
    return check_rows(
        "staging",
        metrics,
        [
            equal(f"Staging rows match raw {spec.period_name} rows", c("staged"), c("raw.rows")),
            parts_make_whole("Valid plus invalid rows match staging rows", [c("valid"), c("invalid")], c("staged")),
            none_of("Rows with null validity classification", c("unclassified")),
            none_of(f"Staging rows outside {spec.period_name}", c("outside")),
            none_of("Valid rows with nonpositive duration", c(FLAGS[0])),
            none_of("Valid rows with nonpositive distance", c(FLAGS[1])),
            none_of(f"Valid rows with distance above {spec.max_distance:g} {spec.distance_unit}", c(FLAGS[2])),
            none_of("Valid rows with invalid amount", c(FLAGS[3])),
            none_of("Invalid rows without a quality flag", c("unexplained")),
        ],
    )


def label_groups(enriched: DataFrame, spec: TripSpec) -> DataFrame:
    """Enriched trips counted per pair of locations and labels, with the rows that break each rule.

    Labels can be compared with the lookup on these few groups instead of on every trip.
    """
    pickup, dropoff = F.col(spec.pickup_ts), F.col(spec.dropoff_ts)
    distance = F.col(spec.distance)
    broken = {
        "outside": any_of(pickup < wall_clock(spec.period_start), pickup >= wall_clock(spec.period_end)),
        "ineligible": is_false(F.col(VALID)),
        "bad_distance": any_of(distance > spec.max_distance, distance <= 0, distance.isNull()),
        "bad_duration": dropoff <= pickup,
        "bad_amount": any_of(F.col(spec.total) <= 0, F.col(spec.fare) < 0),
        "unreported": F.col(spec.party).isNull(),
    }
    return enriched.groupBy(
        F.col(spec.origin_id).alias("origin_id"), F.col(spec.dest_id).alias("dest_id"), *LABELS
    ).agg(F.count(F.lit(1)).alias("trips"), *(F.count_if(rule).alias(name) for name, rule in broken.items()))


def label_metrics(groups: DataFrame, spec: TripSpec) -> DataFrame:
    """One row of totals over the label groups."""

    def trips_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("trips"))), F.lit(0))

    return groups.agg(
        *(_count(c) for c in ("trips", "outside", "ineligible", "bad_distance", "bad_duration", "bad_amount", "unreported")),
        trips_where(F.col("pickup_zone").isNull()).alias("no_pickup_zone"),
        trips_where(F.col("dropoff_zone").isNull()).alias("no_dropoff_zone"),
        trips_where(
            any_of(F.col("dropoff_zone") == spec.outside_zone, F.col("pickup_zone") == spec.outside_zone)
        ).alias("outside_zone_trips"),
    )


def label_mismatches(groups: DataFrame, lookup: DataFrame, spec: TripSpec) -> DataFrame:
    """Trips whose labels are not those of their location in the lookup, per end of the trip."""
    small = bounded(lookup.select(spec.location_id, spec.zone, spec.borough))
    joined, wrong = groups, {}
    for role, location in (("pickup", "origin_id"), ("dropoff", "dest_id")):
        side = label_side(small, spec, role)
        side = side.select(*(F.col(c).alias(f"lookup_{c}") for c in side.columns))
        joined = joined.join(side, joined[location] == side[f"lookup_{role}_key"], "left")
        wrong[role] = any_of(
            F.col(f"lookup_{role}_key").isNull(),
            differs(F.col(f"{role}_zone"), F.col(f"lookup_{role}_zone")),
            differs(F.col(f"{role}_borough"), F.col(f"lookup_{role}_borough")),
        )
    return joined.agg(
        *(F.coalesce(F.sum(F.when(rule, F.col("trips"))), F.lit(0)).alias(role) for role, rule in wrong.items())
    )


def checks_enriched(e: Evidence) -> DataFrame:
    spec = e.spec
    groups = e.keep(label_groups(e.enriched, spec), "label-groups")
    ids = e.lookup.agg((F.count(spec.location_id) - F.countDistinct(spec.location_id)).alias("repeated"))
    metrics = label_metrics(groups, spec).withColumns(
        {
            "staged": only_row(e.staged.agg(F.count_if(is_true(F.col(VALID))).alias("valid"))),
            "ids": only_row(ids),
            "wrong": only_row(label_mismatches(groups, e.lookup, spec)),
        }
    )
    c = F.col
    return check_rows(
        "enriched",
        metrics,
        [
            equal("Enriched row count matches valid staging count", c("trips"), c("staged.valid")),
            none_of(f"Enriched rows outside {spec.period_name}", c("outside")),
            none_of("Invalid trips present in enriched", c("ineligible")),
            none_of("Enriched trips violating distance rules", c("bad_distance")),
            none_of("Enriched trips with nonpositive duration", c("bad_duration")),
            none_of("Enriched trips with invalid amounts", c("bad_amount")),
            none_of("Enriched trips with null pickup zone", c("no_pickup_zone")),
            none_of("Enriched trips with null dropoff zone", c("no_dropoff_zone")),
            none_of("Duplicate location IDs in lookup", c("ids.repeated")),
            none_of("Pickup labels match pickup location ID", c("wrong.pickup")),
            none_of("Dropoff labels match dropoff location ID", c("wrong.dropoff")),
        ],
    )


def checks_daily(e: Evidence) -> DataFrame:
    report = e.marts["daily_demand_revenue"]
    days = regrouped(e.totals(("pickup_date",)), "pickup_date")
    source = days.agg(
        _count("trips"), sum_of_parts(days, "fares").alias("fares"), sum_of_parts(days, "payments").alias("payments"),
        F.sum("passengers").alias("passengers"), F.count("pickup_date").alias("dates"),
    )
    wrong = null_safe_join(report, days, ["pickup_date"]).agg(
        F.count_if(
            far_or_one_sided(F.col("avg_passenger_amount"), ratio(F.col("passengers"), F.col("reported_trips")), 1e-6)
        ).alias("averages")
    )
    metrics = report.agg(
        *_rows("pickup_date"),
        F.sum("daily_trip_count").alias("trips"),
        exact_sum(report, "total_metered_fares").alias("fares"),
        exact_sum(report, "total_passenger_amount_paid").alias("payments"),
        F.sum("total_passengers").alias("passengers"),
    ).withColumns({"source": only_row(source), "wrong": only_row(wrong)})
    c = F.col
    return check_rows(
        "daily",
        metrics,
        [
            equal("Daily trip counts reconcile to enriched trips", c("trips"), c("source.trips")),
            reconciles("Daily metered fares reconcile to enriched trips", c("fares"), c("source.fares"), "0.01"),
            reconciles("Daily passenger amounts reconcile to enriched trips", c("payments"), c("source.payments"), "0.01"),
            equal("Daily reported passengers reconcile to enriched trips", c("passengers"), c("source.passengers")),
            one_row_per("Daily result contains one row per observed date", c("rows"), c("source.dates")),
            unique("Daily result has no duplicate dates", c("rows"), c("keys")),
            none_of("Daily passenger averages match enriched trips", c("wrong.averages")),
        ],
    )


def checks_zones(e: Evidence) -> DataFrame:
    report = e.marts["zone_performance"]
    keys = ["pickup_zone", "pickup_borough"]
    zones = regrouped(e.totals(tuple(keys)), *keys)
    source = zones.agg(
        _count("trips"), sum_of_parts(zones, "fares").alias("fares"), sum_of_parts(zones, "payments").alias("payments"),
        F.sum("passengers").alias("passengers"), F.count(F.lit(1)).alias("zones"),
    )
    expected = round_to(ratio(F.col("passengers"), F.col("reported_trips")), 2)
    wrong = null_safe_join(report, zones, keys).agg(
        F.count_if(differs(F.col("avg_passenger_per_trip"), expected)).alias("averages")
    )
    metrics = report.agg(
        *_rows(*keys),
        F.sum("total_trip_count").alias("trips"),
        exact_sum(report, "total_metered_fares").alias("fares"),
        exact_sum(report, "total_passenger_amount_paid").alias("payments"),
        F.sum("total_passengers").alias("passengers"),
    ).withColumns({"source": only_row(source), "wrong": only_row(wrong)})
    c = F.col
    return check_rows(
        "zones",
        metrics,
        [
            equal("Zone trips reconcile", c("trips"), c("source.trips")),
            reconciles_rounded(
                "Zone metered fares reconcile (rounded by zone)", c("fares"), c("source.fares"), c("source.zones"), "0.005"
            ),
            reconciles_rounded(
                "Zone passenger amounts reconcile (rounded by zone)",
                c("payments"), c("source.payments"), c("source.zones"), "0.5",
            ),
            equal("Zone reported passengers reconcile", c("passengers"), c("source.passengers")),
            one_row_per("One result row per zone and borough", c("rows"), c("source.zones")),
            unique("No duplicate zone and borough keys", c("rows"), c("keys")),
            none_of("Passenger averages use reported-trip denominator", c("wrong.averages")),
        ],
    )


def checks_hourly(e: Evidence) -> DataFrame:
    report = e.marts["hourly_demand"]
    date_hours = regrouped(e.totals(("pickup_date", "pickup_hour")), "pickup_date", "pickup_hour")
    sums = ("trips", "reported_trips", "passengers", "fares", "payments", "miles", "minutes")
    hours = date_hours.groupBy("pickup_hour").agg(
        F.count("pickup_date").alias("days"), *(add_parts(date_hours, c).alias(c) for c in sums)
    )
    source = hours.agg(
        _count("trips"), F.sum("passengers").alias("passengers"), sum_of_parts(hours, "fares").alias("fares"),
        sum_of_parts(hours, "payments").alias("payments"), F.count("pickup_hour").alias("hours"),
    )
    hours = with_values(hours)
    c = F.col
    formulas = {
        "avg_daily_trips": round_to(ratio(c("trips"), c("days")), 2),
        "passenger_count_coverage_pct": round_to(F.lit(100.0) * c("reported_trips") / c("trips"), 2),
        "avg_passenger_amount_per_trip": round_to(ratio(c("payments"), c("trips")), 2),
        "avg_trip_distance_miles": round_to(ratio(c("miles"), c("trips")), 2),
        "avg_trip_duration_minutes": round_to(ratio(c("minutes"), c("trips")), 2),
    }
    wrong = report.join(hours, "pickup_hour").agg(
        F.count_if(
            any_of(differs(c("days_observed"), c("days")), *(differs(c(name), value) for name, value in formulas.items()))
        ).alias("hours")
    )
    metrics = report.agg(
        *_rows("pickup_hour"),
        F.sum("total_trips").alias("trips"),
        F.sum("total_reported_passengers").alias("passengers"),
        exact_sum(report, "total_metered_fares").alias("fares"),
        exact_sum(report, "total_passenger_amount").alias("payments"),
    ).withColumns({"source": only_row(source), "wrong": only_row(wrong)})
    return check_rows(
        "hourly",
        metrics,
        [
            equal("Hourly trips reconcile", c("trips"), c("source.trips")),
            equal("Hourly reported passengers reconcile", c("passengers"), c("source.passengers")),
            reconciles_rounded(
                "Hourly metered fares reconcile (rounded by hour)", c("fares"), c("source.fares"), c("source.hours"), "0.005"
            ),
            reconciles_rounded(
                "Hourly passenger amounts reconcile (rounded by hour)",
                c("payments"), c("source.payments"), c("source.hours"), "0.005",
            ),
            one_row_per("One result row per observed hour", c("rows"), c("source.hours")),
            unique("No duplicate hours", c("rows"), c("keys")),
            none_of("Hourly denominators and averages match source", c("wrong.hours")),
        ],
    )


def checks_zone_hourly(e: Evidence) -> DataFrame:
    detail, report = e.marts["zone_hourly_demand"], e.marts["zone_hourly_performance"]
    cell = ["pickup_hour", "pickup_borough", "pickup_zone"]
    groups = regrouped(e.totals(tuple(cell)), *cell)
    source = groups.agg(
        _count("trips"),
        *(sum_of_parts(groups, c).alias(c) for c in ("passengers", "payments", "miles", "minutes")),
        F.count(F.lit(1)).alias("cells"),
    )
    c = F.col
    days = detail.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("active"),
        F.count("hourly_passenger_count").alias("reporting"),
        F.sum("trips_in_hour").alias("trips"),
        F.sum("hourly_passenger_count").alias("passengers"),
        exact_sum(detail, "hourly_passenger_amount").alias("payments"),
        exact_sum(detail, "hourly_trip_distance").alias("miles"),
        exact_sum(detail, "hourly_trip_duration_minutes").alias("minutes"),
    )
    shown = report.withColumnRenamed("pickup_hour_of_the_day", "pickup_hour")
    half = 0.500001
    off = any_of(
        far(c("avg_trips_per_active_day"), ratio(c("trips"), c("active")), half),
        differs(c("avg_reported_passengers_per_active_day").isNull(), c("passengers").isNull()),
        far(c("avg_reported_passengers_per_active_day"), ratio(c("passengers"), c("reporting")), half),
        far(c("avg_passenger_amount_per_active_day"), ratio(c("payments"), c("active")), half),
        far(c("avg_trip_miles_per_active_day"), ratio(c("miles"), c("active")), half),
        far(c("avg_trip_minutes_per_active_day"), ratio(c("minutes"), c("active")), half),
    )
    wrong = null_safe_join(shown, days, cell).agg(F.count_if(off).alias("averages"))
    metrics = detail.agg(
        *_rows("pickup_date", *cell),
        F.sum("trips_in_hour").alias("trips"),
        F.sum("hourly_passenger_count").alias("passengers"),
        exact_sum(detail, "hourly_passenger_amount").alias("payments"),
        exact_sum(detail, "hourly_trip_distance").alias("miles"),
        exact_sum(detail, "hourly_trip_duration_minutes").alias("minutes"),
    ).withColumns(
        {"source": only_row(source), "shown": only_row(shown.agg(*_rows(*cell))), "wrong": only_row(wrong)}
    )
    return check_rows(
        "zone_hourly",
        metrics,
        [
            equal("Zone-hour underlying trips reconcile", c("trips"), c("source.trips")),
            equal("Zone-hour reported passengers reconcile", c("passengers"), c("source.passengers")),
            reconciles("Zone-hour passenger amounts reconcile", c("payments"), c("source.payments"), "0.01"),
            reconciles("Zone-hour trip distance reconciles", c("miles"), c("source.miles"), "0.01"),
            reconciles("Zone-hour trip duration reconciles", c("minutes"), c("source.minutes"), "0.01"),
            unique("No duplicate date-zone-hour keys", c("rows"), c("keys")),
            one_row_per("One result row per zone and hour", c("shown.rows"), c("source.cells")),
            unique("No duplicate zone-hour result keys", c("shown.rows"), c("shown.keys")),
            none_of("Zone-hour active-day averages match inputs", c("wrong.averages")),
        ],
    )


def checks_routes(e: Evidence) -> DataFrame:
    detail, report = e.marts["route_performance"], e.marts["route_analysis"]
    groups = regrouped(e.totals(ROUTE), *ROUTE)
    source = groups.agg(
        *(_count(c) for c in ("trips", "same_place_trips", "other_place_trips")),
        *(sum_of_parts(groups, c).alias(c) for c in ("payments", "miles", "minutes")),
        F.count(F.lit(1)).alias("routes"),
    )
    c = F.col
    per_trip = {
        "avg_route_amount": ("route_total_amount", 0.005001),
        "avg_route_trip_distance": ("route_total_trip_distance", 0.005001),
        "avg_route_trip_duration": ("route_total_trip_duration", 0.500001),
    }
    off = any_of(
        differs(c("a.route_total_trips"), c("b.route_total_trips")),
        *(far(c(f"a.{shown}"), ratio(c(f"b.{total}"), c("b.route_total_trips")), t) for shown, (total, t) in per_trip.items()),
    )
    wrong = null_safe_join(report, detail, list(ROUTE)).agg(F.count_if(off).alias("averages"))

    def trips_of(category: str) -> Column:
        return F.sum(F.when(c("route_category") == category, c("route_total_trips")))

    metrics = detail.agg(
        *_rows(*ROUTE),
        F.sum("route_total_trips").alias("trips"),
        exact_sum(detail, "route_total_amount").alias("payments"),
        exact_sum(detail, "route_total_trip_distance").alias("miles"),
        exact_sum(detail, "route_total_trip_duration").alias("minutes"),
        trips_of(SAME_ZONE).alias("same"),
        trips_of(CROSS_ZONE).alias("cross"),
    ).withColumns({"source": only_row(source), "wrong": only_row(wrong)})
    return check_rows(
        "routes",
        metrics,
        [
            equal("Route trips reconcile", c("trips"), c("source.trips")),
            reconciles("Route passenger amounts reconcile", c("payments"), c("source.payments"), "0.01"),
            reconciles("Route trip distances reconcile", c("miles"), c("source.miles"), "0.01"),
            reconciles("Route trip durations reconcile", c("minutes"), c("source.minutes"), "0.01"),
            equal("Same-zone routes reconcile by location ID", c("same"), c("source.same_place_trips")),
            equal("Cross-zone routes reconcile by location ID", c("cross"), c("source.other_place_trips")),
            parts_make_whole("Route categories account for all trips", [c("same"), c("cross")], c("trips")),
            one_row_per("One result row per route and category", c("rows"), c("source.routes")),
            unique("No duplicate route-category keys", c("rows"), c("keys")),
            none_of("Route averages match unrounded totals", c("wrong.averages")),
        ],
    )


def checks_presentation(e: Evidence) -> DataFrame:
    spec = e.spec
    segments, windows = e.marts["airport_comparison"], e.marts["priority_windows"]
    cells = e.totals(("pickup_date", "pickup_hour", "origin_id"))
    source = cells.agg(
        _count("trips"), sum_of_parts(cells, "payments").alias("payments"),
        F.min("pickup_date").alias("first"), F.max("pickup_date").alias("last"),
    )
    # trips of each listed location in its peak hour, zero where there are none
    hour_trips = cells.groupBy(
        F.col("origin_id").alias("pickup_location_id"), F.col("pickup_hour").cast("int").alias("peak_hour")
    ).agg(F.sum("trips").alias("hour_trips"))
    c = F.col
    per_day = F.coalesce(c("hour_trips"), F.lit(0)) / F.lit(float(spec.calendar_days))
    wrong = windows.join(hour_trips, ["pickup_location_id", "peak_hour"], "left").agg(
        F.count_if(far(c("avg_peak_hour_trips_per_calendar_day"), per_day, 0.0051)).alias("windows")
    )
    metrics = segments.agg(
        F.sum("total_trips").alias("trips"), exact_sum(segments, "total_recorded_payment_usd").alias("payments")
    ).withColumns(
        {
            "source": only_row(source),
            "windows": only_row(windows.agg(*_rows("pickup_location_id"))),
            "wrong": only_row(wrong),
        }
    )
    wanted = F.lit(spec.priority_zones)
    return check_rows(
        "presentation",
        metrics,
        [
            equal("Airport segments preserve all eligible trips", c("trips"), c("source.trips")),
            reconciles("Airport payments reconcile", c("payments"), c("source.payments"), "0.02"),
            equal(f"Exactly {_word(spec.priority_zones)} priority zones", c("windows.rows"), wanted),
            equal("Priority zone IDs are unique", c("windows.keys"), wanted),
            spans(f"{spec.period_name} has the expected calendar span", c("source.first"), c("source.last"), spec.calendar_days),
            none_of(f"Peak averages use all {spec.calendar_days} days", c("wrong.windows")),
        ],
    )


def _word(n: int) -> str:
    words = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")
    return words[n] if n < len(words) else str(n)


# Reports by key, and the columns of the expected totals that must hold the same groups.
GROUPED = {
    "daily_demand_revenue": ("Dates", {"pickup_date": "pickup_date"}),
    "zone_performance": ("Zones", {"pickup_zone": "pickup_zone", "pickup_borough": "pickup_borough"}),
    "hourly_demand": ("Hours", {"pickup_hour": "pickup_hour"}),
    "zone_hourly_demand": (
        "Date-zone-hours",
        {"pickup_date": "pickup_date", "pickup_hour": "pickup_hour", "pickup_borough": "pickup_borough", "pickup_zone": "pickup_zone"},
    ),
    "zone_hourly_performance": (
        "Zone-hours",
        {"pickup_hour_of_the_day": "pickup_hour", "pickup_borough": "pickup_borough", "pickup_zone": "pickup_zone"},
    ),
    "route_analysis": ("Routes", {key: key for key in ROUTE}),
}


def one_sided(report: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys are in one of two frames only, as `unmatched`. Nulls are keys like any other; both sides hold a row
    per key and are joined as a whole, so a group that only one of them knows is seen whichever it is."""
    left = report.groupBy(*keys).agg(F.lit(1).alias("in_report"))
    right = groups.groupBy(*keys).agg(F.lit(1).alias("in_source"))
    met = null_safe_join(left, right, keys, "full")
    return met.agg(F.count_if(F.col("in_report").isNull() | F.col("in_source").isNull()).alias("unmatched"))


def checks_completeness(e: Evidence) -> DataFrame:
    """Beside the 66 checks: no group of trips is missing from a report, and no report has a group without trips.

    The formula checks compare groups that both sides know. A group dropped from a report and one invented in its place
    keep the number of rows, and totals within their tolerance where the group is small.
    """
    checks, metrics = [], None
    for name, (label, keys) in GROUPED.items():
        shown = e.marts[name].select(*(F.col(c).alias(k) for c, k in keys.items()))
        groups = e.totals(tuple(ROUTE) if name == "route_analysis" else tuple(keys.values()))
        found = only_row(one_sided(shown, groups, list(keys.values())))
        metrics = e.lookup.sparkSession.range(1).select(found.alias(name)) if metrics is None else metrics.withColumn(name, found)
        checks.append(none_of(f"{label} in the report or in the trips only", F.col(f"{name}.unmatched")))
    return check_rows("completeness", metrics, checks)


SUITES: dict[str, Callable[[Evidence], DataFrame]] = {
    "checks_staging": checks_staging,
    "checks_enriched": checks_enriched,
    "checks_daily": checks_daily,
    "checks_zones": checks_zones,
    "checks_hourly": checks_hourly,
    "checks_zone_hourly": checks_zone_hourly,
    "checks_routes": checks_routes,
    "checks_presentation": checks_presentation,
}


def all_checks(e: Evidence) -> DataFrame:
    return reduce(DataFrame.unionByName, (suite(e) for suite in SUITES.values()))


def gate(checks: DataFrame) -> DataFrame:
    """One row: how many checks ran, how many failed, and the verdict."""
    failed = F.count_if(differs(F.col("check_status"), F.lit("PASS")))
    return checks.agg(F.count(F.lit(1)).alias("checks_run"), failed.alias("checks_failed")).withColumn(
        "verdict", F.when((F.col("checks_run") > 0) & (F.col("checks_failed") == 0), "PASS").otherwise("FAIL")
    )
