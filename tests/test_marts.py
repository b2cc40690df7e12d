"""Reports against a plain-Python calculation over the same rows."""

from collections import defaultdict
from datetime import timedelta
from fractions import Fraction

import pytest
from conftest import WEEK, trip

from tripgrain.operators.enrich import enrich
from tripgrain.operators.staging import clean_trips
from tripgrain.operators.totals import PLACE_HOUR, ROUTE, trip_totals
from tripgrain.plans.marts import REPORTS, all_marts, mart

ZONES = {1: ("JFK Airport", "Queens"), 2: ("Midtown Center", "Manhattan"), 3: ("Corona", "Queens")}
ZONES |= {4: ("Corona", "Queens"), 5: ("Outside of NYC", "N/A"), 6: ("East Village", "Manhattan")}


@pytest.fixture(scope="module")
def enriched(trips_of, places, week_rows):
    return enrich(clean_trips(trips_of(week_rows), WEEK), places, WEEK).cache()


@pytest.fixture(scope="module")
def eligible(week_rows):
    """The same rows as dictionaries, filtered by hand."""
    rows = []
    for pickup, dropoff, distance, fare, total, party, origin, dest in week_rows:
        if WEEK.period_start <= pickup < WEEK.period_end and dropoff > pickup and 0 < distance <= 500 and total > 0:
            minutes = round((dropoff - pickup) / timedelta(minutes=1), 2)
            rows.append(
                dict(pickup=pickup, distance=distance, fare=fare, total=total, party=party, origin=origin, dest=dest, minutes=minutes)
            )
    return rows


def grouped(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    return groups


def exact(rows, field):
    known = [Fraction(r[field]) for r in rows if r[field] is not None]
    return float(sum(known)) if known else None


def rounded(x, places=0):
    if x is None:
        return None
    scaled = x * 10**places
    whole = int(abs(scaled) + 0.5) if abs(scaled) - int(abs(scaled)) != 0.5 else int(abs(scaled)) + 1
    return (whole if x >= 0 else -whole) / 10**places


def average(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def test_daily(enriched, eligible):
    got = {r.pickup_date: r for r in mart("daily_demand_revenue", enriched, WEEK).collect()}
    want = grouped(eligible, lambda r: r["pickup"].date())
    assert got.keys() == want.keys()
    for day, rows in want.items():
        row = got[day]
        assert row.daily_trip_count == len(rows)
        assert row.total_metered_fares == exact(rows, "fare")
        assert row.total_passenger_amount_paid == exact(rows, "total")
        assert row.avg_passenger_amount == average([r["party"] for r in rows])


def test_zones_merge_locations_of_one_name(enriched, eligible):
    got = {(r.pickup_zone, r.pickup_borough): r for r in mart("zone_performance", enriched, WEEK).collect()}
    want = grouped(eligible, lambda r: ZONES[r["origin"]])
    assert got.keys() == want.keys() and len(got) == 5
    for key, rows in want.items():
        assert got[key].total_trip_count == len(rows)
        assert got[key].total_metered_fares == rounded(exact(rows, "fare"), 2)
        assert got[key].total_passenger_amount_paid == rounded(exact(rows, "total"))
        assert got[key].avg_passenger_per_trip == rounded(average([r["party"] for r in rows]), 2)


def test_hours_average_over_observed_dates(enriched, eligible):
    got = {r.pickup_hour: r for r in mart("hourly_demand", enriched, WEEK).collect()}
    want = grouped(eligible, lambda r: r["pickup"].hour)
    assert got.keys() == want.keys()
    for hour, rows in want.items():
        days = grouped(rows, lambda r: r["pickup"].date())
        row = got[hour]
        assert (row.days_observed, row.total_trips) == (len(days), len(rows))
        assert row.avg_daily_trips == rounded(len(rows) / len(days), 2)
        reported = [r for r in rows if r["party"] is not None]
        assert row.passenger_count_coverage_pct == rounded(100.0 * len(reported) / len(rows), 2)
        assert row.avg_daily_reported_passengers == rounded(average([exact(d, "party") for d in days.values()]), 2)
        assert row.total_passenger_amount == rounded(exact(rows, "total"), 2)
        assert row.avg_trip_duration_minutes == rounded(exact(rows, "minutes") / len(rows), 2)


def test_zone_hours_average_over_active_days(enriched, eligible):
    report = mart("zone_hourly_performance", enriched, WEEK).collect()
    got = {(r.pickup_hour_of_the_day, r.pickup_zone): r for r in report}
    want = grouped(eligible, lambda r: (r["pickup"].hour, ZONES[r["origin"]][0]))
    assert got.keys() == want.keys() and len(report) == len(got)
    for key, rows in want.items():
        days = grouped(rows, lambda r: r["pickup"].date())
        assert got[key].avg_trips_per_active_day == rounded(len(rows) / len(days))
        assert got[key].avg_reported_passengers_per_active_day == rounded(average([exact(d, "party") for d in days.values()]))
        assert got[key].avg_passenger_amount_per_active_day == rounded(exact(rows, "total") / len(days))


def test_zone_hour_detail(enriched, eligible):
    got = {(r.pickup_date, r.pickup_hour, r.pickup_zone): r for r in mart("zone_hourly_demand", enriched, WEEK).collect()}
    want = grouped(eligible, lambda r: (r["pickup"].date(), r["pickup"].hour, ZONES[r["origin"]][0]))
    assert got.keys() == want.keys()
    for key, rows in want.items():
        assert got[key].hourly_trip_duration_minutes == exact(rows, "minutes")
        assert got[key].hourly_passenger_count == exact(rows, "party")


def test_routes_compare_ids_not_names(trips_of, places):
    rows = [trip(origin=3, dest=4), trip(origin=3, dest=3), trip(origin=4, dest=3), trip(origin=4, dest=4)]
    rows += [trip(origin=None, dest=None, total=20.0), trip(origin=99, dest=99)]
    twins = enrich(clean_trips(trips_of(rows), WEEK), places, WEEK)
    got = {(r.pickup_zone, r.dropoff_zone, r.route_category): r.route_total_trips for r in mart("route_performance", twins, WEEK).collect()}
    assert got == {
        ("Corona", "Corona", "Cross-Zone"): 2,
        ("Corona", "Corona", "Same-Zone"): 2,
        (None, None, "Cross-Zone"): 1,
        (None, None, "Same-Zone"): 1,
    }


def test_route_averages(enriched, eligible):
    got = {(r.pickup_zone, r.dropoff_zone, r.route_category): r for r in mart("route_analysis", enriched, WEEK).collect()}

    def key(r):
        return ZONES[r["origin"]][0], ZONES[r["dest"]][0], "Same-Zone" if r["origin"] == r["dest"] else "Cross-Zone"

    want = grouped(eligible, key)
    assert got.keys() == want.keys()
    for route, rows in want.items():
        assert got[route].route_total_trips == len(rows)
        assert got[route].avg_route_amount == rounded(exact(rows, "total") / len(rows), 2)
        assert got[route].avg_route_trip_duration == rounded(exact(rows, "minutes") / len(rows))


def test_priority_ties_go_to_lower_id_and_earlier_hour(trips_of, places):
    rows = [trip(f"2026-01-0{d} {h}:00:00", f"2026-01-0{d} {h}:30:00", origin=o) for o in (6, 3, 1) for d, h in ((5, 12), (6, 11))]
    rows.append(trip(origin=2))
    ranked = mart("priority_windows", enrich(clean_trips(trips_of(rows), WEEK), places, WEEK), WEEK).orderBy("zone_rank").collect()
    assert [(r.zone_rank, r.pickup_location_id, r.peak_hour) for r in ranked] == [(1, 1, 11), (2, 3, 11)]
    # one trip in the peak hour over the seven days of the period, idle days included
    assert ranked[0].avg_peak_hour_trips_per_calendar_day == 0.14
    assert ranked[0].monthly_trip_share_pct == 28.57


def test_priority_keeps_locations_of_one_name_apart(trips_of, places):
    rows = [trip(origin=3)] * 3 + [trip(origin=4)] * 2 + [trip(origin=1)]
    ranked = mart("priority_windows", enrich(clean_trips(trips_of(rows), WEEK), places, WEEK), WEEK).collect()
    assert {(r.pickup_location_id, r.monthly_trips) for r in ranked} == {(3, 3), (4, 2)}


def test_a_ranked_unknown_location_takes_its_rank_but_shows_no_window(trips_of, places):
    rows = [trip(origin=None)] * 3 + [trip(origin=1)] * 2 + [trip(origin=2)]
    ranked = mart("priority_windows", enrich(clean_trips(trips_of(rows), WEEK), places, WEEK), WEEK).collect()
    assert [(r.zone_rank, r.pickup_location_id) for r in ranked] == [(2, 1)]


def test_segments(trips_of, places):
    rows = [trip(origin=132, total=80.0), trip(origin=132, total=None), trip(origin=138, dropoff=None), trip(origin=None)]
    got = {r.pickup_segment: r for r in mart("airport_comparison", enrich(clean_trips(trips_of(rows), WEEK), places, WEEK), WEEK).collect()}
    assert {k: v.total_trips for k, v in got.items()} == {"JFK Airport": 2, "LaGuardia Airport": 1, "Other pickup zones": 1}
    assert got["JFK Airport"].avg_recorded_payment_usd == 80.0  # over the one known payment
    assert got["LaGuardia Airport"].avg_trip_minutes is None


def test_unreported_groups_have_null_sums_and_means(trips_of, places):
    rows = [trip(party=None, origin=6), trip(party=None, origin=6)]
    row = mart("zone_performance", enrich(clean_trips(trips_of(rows), WEEK), places, WEEK), WEEK).first()
    assert (row.total_passengers, row.avg_passenger_per_trip, row.total_trip_count) == (None, None, 2)


def test_active_days_against_calendar_days(trips_of, places):
    rows = [trip(origin=1)] * 4 + [trip("2026-01-06 10:00:00", "2026-01-06 10:15:00", origin=1)] * 2
    enriched = enrich(clean_trips(trips_of(rows), WEEK), places, WEEK)
    assert mart("zone_hourly_performance", enriched, WEEK).first().avg_trips_per_active_day == 3.0
    assert mart("priority_windows", enriched, WEEK).first().avg_peak_hour_trips_per_calendar_day == 0.86


@pytest.mark.parametrize("name", list(REPORTS))
def test_stored_totals_give_the_same_report(enriched, name):
    shared = all_marts(trip_totals(enriched, WEEK, *PLACE_HOUR), trip_totals(enriched, WEEK, *ROUTE), WEEK)[name]
    direct = mart(name, enriched, WEEK)
    assert shared.schema.names == direct.schema.names
    assert sorted(map(str, shared.collect())) == sorted(map(str, direct.collect()))


def test_a_dominant_key_changes_nothing(trips_of, places):
    """A third of all trips on one key, spread over many partitions: the same totals as in one partition."""
    rows = [trip(origin=2 if i % 3 == 0 else 1 + i % 6, dest=1 + i % 6, total=round(5 + i * 0.01, 2)) for i in range(3000)]
    one = enrich(clean_trips(trips_of(rows).coalesce(1), WEEK), places, WEEK)
    many = enrich(clean_trips(trips_of(rows).repartition(16), WEEK), places, WEEK)
    for name in REPORTS:
        assert sorted(map(str, mart(name, one, WEEK).collect())) == sorted(map(str, mart(name, many, WEEK).collect()))
