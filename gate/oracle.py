"""The same questions as SQL text for DuckDB, over the same tables.

Written straight from trips to answer, without the two-level totals of the Spark plans, so that the two sides
share no intermediate step. Doubles are summed as whole multiples of 2^-66 in 128-bit integers, which loses nothing at
the size of these tables, and a sum becomes the nearest double, so it does not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

PERIOD = "TIMESTAMP '1998-01-01'", "TIMESTAMP '1999-01-01'"
EVENT_PERIOD = "TIMESTAMP '2024-01-08'", "TIMESTAMP '2024-01-22'"

TRIPS = """
trips AS (
  SELECT l_orderkey, l_partkey, l_linenumber,
         o_orderdate + to_seconds((l_orderkey * 37) % 86400) AS pickup_ts,
         o_orderdate + to_seconds((l_orderkey * 37) % 86400 + (l_partkey * 101) % 7200 - 120) AS dropoff_ts,
         s_nationkey AS origin_id, c_nationkey AS dest_id, l_quantity - 2 AS distance,
         sign * l_extendedprice AS fare_amount,
         sign * l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount,
         CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS party_size
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN -1 ELSE 1 END AS sign FROM lineitem)
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey)"""

GAPPY_TRIPS = (
    TRIPS.replace("trips AS (", "whole_trips AS (", 1)
    + """,
trips AS (
  SELECT * REPLACE (
    CASE WHEN l_partkey % 11 <> 0 THEN dropoff_ts END AS dropoff_ts,
    nullif(distance, 8) AS distance,
    CASE WHEN l_linenumber <> 6 THEN total_amount END AS total_amount,
    CASE WHEN l_linenumber <> 7 THEN fare_amount END AS fare_amount,
    nullif(dest_id, 9) AS dest_id)
  FROM whole_trips)"""
)

EVENT_TRIPS = """
trips AS (
  SELECT event_id, ts AS pickup_ts,
         ts + to_microseconds(CAST(round(value * 60000000 - 300000000) AS BIGINT)) AS dropoff_ts,
         c_nationkey AS origin_id, CAST((c_nationkey + length(event_type)) % 25 AS INTEGER) AS dest_id,
         value AS distance, CAST(CAST(value AS DECIMAL(18,6)) AS DECIMAL(18,2)) AS fare_amount,
         CAST(CAST(value AS DECIMAL(18,6)) - 5 AS DECIMAL(18,6)) AS total_amount,
         CASE WHEN event_type <> 'error' THEN CAST(length(event_type) AS INTEGER) END AS party_size
  FROM events JOIN customer ON c_custkey = user_id)"""

PLACES = """
places AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON r_regionkey = n_regionkey)"""

SHORT_PLACES = """
places AS (
  SELECT n_nationkey AS location_id,
         CASE WHEN n_nationkey IN (13, 15) THEN 'TWIN' ELSE r_name END AS borough,
         CASE WHEN n_nationkey = 15 THEN 'NATION_13' ELSE n_name END AS zone
  FROM nation JOIN region ON r_regionkey = n_regionkey
  WHERE n_nationkey <> 12)"""


def staged(period=PERIOD, cap=45) -> str:
    return f"""
staged AS (
  SELECT *, CAST(dropoff_ts - pickup_ts AS VARCHAR) AS trip_duration_hms,
         round(date_diff('second', pickup_ts, dropoff_ts) / 60.0, 2) AS trip_duration_minutes,
         coalesce(dropoff_ts <= pickup_ts, FALSE) AS has_nonpositive_duration,
         coalesce(distance <= 0, FALSE) AS has_nonpositive_distance,
         coalesce(distance > {cap}, FALSE) AS has_excessive_distance,
         coalesce(total_amount <= 0 OR fare_amount < 0, FALSE) AS has_invalid_amount,
         NOT (has_nonpositive_duration OR has_nonpositive_distance OR has_excessive_distance
              OR has_invalid_amount) AS is_valid_completed_trip
  FROM trips WHERE pickup_ts >= {period[0]} AND pickup_ts < {period[1]})"""


ENRICHED = """
enriched AS (
  SELECT staged.*, a.zone AS pickup_zone, a.borough AS pickup_borough,
         b.zone AS dropoff_zone, b.borough AS dropoff_borough, pickup_ts::DATE AS pickup_date
  FROM staged LEFT JOIN places a ON a.location_id = origin_id LEFT JOIN places b ON b.location_id = dest_id
  WHERE is_valid_completed_trip)"""

MAIN = ",".join((TRIPS, PLACES, staged(), ENRICHED))
GAPPY = ",".join((GAPPY_TRIPS, SHORT_PLACES, staged(), ENRICHED))
REFRESHED = ",".join((TRIPS, PLACES, staged(("TIMESTAMP '1998-03-01'", PERIOD[1])), ENRICHED))
EVENT = ",".join((EVENT_TRIPS, PLACES, staged(EVENT_PERIOD, 80), ENRICHED))

# spellings used throughout
CATEGORY = "CASE WHEN origin_id = dest_id THEN 'Same-Zone' ELSE 'Cross-Zone' END"
HOUR = "hour(pickup_ts)"


UNIT = "73786976294838206464::DOUBLE"  # 2^66


def units(x: str) -> str:
    """A sum of doubles in units of 2^-66."""
    return f"sum(CAST({x} * {UNIT} AS HUGEINT))"


def amount(units_sum: str) -> str:
    """The double nearest to a sum in units; the direct cast of such an integer would round twice."""
    return f"(CAST(CAST({units_sum} AS VARCHAR) AS DOUBLE) / {UNIT})"


def total(x: str, where: str = "TRUE") -> str:
    return amount(f"{units(x)} FILTER ({where})")


# Measures that are decimals add up as such.
def plain(x: str) -> str:
    return f"sum({x})"


def dbl(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def avg_of(x: str) -> str:
    """Mean of the known values of a column holding exact sums."""
    return f"CAST(CAST(sum({x}) AS VARCHAR) AS DOUBLE) / count({x})"


# --- reports: name -> (extra common table expressions, final select) -------------------------------------

def daily(money: Callable[[str], str] = total) -> str:
    return f"""
SELECT pickup_date, count(*) AS daily_trip_count, {money("fare_amount")} AS total_metered_fares,
       {money("total_amount")} AS total_passenger_amount_paid, {big("sum(party_size)")} AS total_passengers,
       avg(party_size) AS avg_passenger_amount
FROM enriched GROUP BY ALL"""


DAILY = daily()

ZONES = f"""
SELECT pickup_zone, pickup_borough, count(*) AS total_trip_count,
       round({total("fare_amount")}, 2) AS total_metered_fares,
       round({total("total_amount")}) AS total_passenger_amount_paid,
       {big("sum(party_size)")} AS total_passengers, round(avg(party_size), 2) AS avg_passenger_per_trip
FROM enriched GROUP BY pickup_zone, pickup_borough"""

def hourly(part: Callable[[str], str] = units, value: Callable[[str], str] = amount) -> str:
    return f"""
SELECT h AS pickup_hour, count(*) AS days_observed, {big("sum(n)")} AS total_trips,
       round({avg_of("n")}, 2) AS avg_daily_trips,
       {big("sum(p)")} AS total_reported_passengers, round({avg_of("p")}, 2) AS avg_daily_reported_passengers,
       round(100.0 * sum(r)::DOUBLE / sum(n)::DOUBLE, 2) AS passenger_count_coverage_pct,
       round(sum(p)::DOUBLE / nullif(sum(r), 0), 2) AS avg_passengers_per_reported_trip,
       round({value("sum(f)")}, 2) AS total_metered_fares, round({value("sum(f)")} / count(f), 2) AS avg_daily_metered_fares,
       round({value("sum(t)")}, 2) AS total_passenger_amount, round({value("sum(t)")} / count(t), 2) AS avg_daily_passenger_amount,
       round({value("sum(t)")} / sum(n)::DOUBLE, 2) AS avg_passenger_amount_per_trip,
       round({amount("sum(d)")} / sum(n)::DOUBLE, 2) AS avg_trip_distance_miles,
       round({amount("sum(m)")} / sum(n)::DOUBLE, 2) AS avg_trip_duration_minutes
FROM (SELECT pickup_date, {HOUR} AS h, count(*) AS n, count(party_size) AS r, sum(party_size) AS p,
             {part("fare_amount")} AS f, {part("total_amount")} AS t, {units("distance")} AS d, {units("trip_duration_minutes")} AS m
      FROM enriched GROUP BY 1, 2)
GROUP BY h"""


HOURLY = hourly()

ZONE_HOUR_DETAIL = f"""
SELECT pickup_date, {HOUR} AS pickup_hour, count(*) AS trips_in_hour, pickup_borough, pickup_zone,
       {big("sum(party_size)")} AS hourly_passenger_count, {total("total_amount")} AS hourly_passenger_amount,
       {total("distance")} AS hourly_trip_distance, {total("trip_duration_minutes")} AS hourly_trip_duration_minutes
FROM enriched GROUP BY ALL"""

ZONE_HOURS = f"""
SELECT h AS pickup_hour_of_the_day, pickup_zone, pickup_borough,
       round({avg_of("n")}) AS avg_trips_per_active_day,
       round({avg_of("p")}) AS avg_reported_passengers_per_active_day,
       round({amount("sum(t)")} / count(t)) AS avg_passenger_amount_per_active_day,
       round({amount("sum(d)")} / count(d)) AS avg_trip_miles_per_active_day,
       round({amount("sum(m)")} / count(m)) AS avg_trip_minutes_per_active_day
FROM (SELECT pickup_date, {HOUR} AS h, pickup_zone, pickup_borough, count(*) AS n, sum(party_size) AS p,
             {units("total_amount")} AS t, {units("distance")} AS d, {units("trip_duration_minutes")} AS m
      FROM enriched GROUP BY 1, 2, 3, 4)
GROUP BY ALL"""

ROUTE_TOTALS = f"""
SELECT pickup_zone, dropoff_zone, {CATEGORY} AS route_category, count(*) AS route_total_trips,
       {total("total_amount")} AS route_total_amount, {total("trip_duration_minutes")} AS route_total_trip_duration,
       {total("distance")} AS route_total_trip_distance
FROM enriched GROUP BY ALL"""

ROUTE_AVERAGES = f"""
SELECT pickup_zone, dropoff_zone, {CATEGORY} AS route_category, count(*) AS route_total_trips,
       round({total("total_amount")} / count(*), 2) AS avg_route_amount,
       round({total("distance")} / count(*), 2) AS avg_route_trip_distance,
       round({total("trip_duration_minutes")} / count(*)) AS avg_route_trip_duration
FROM enriched GROUP BY ALL"""


def priority(days: float) -> str:
    return f"""
SELECT zone_rank, origin_id AS pickup_location_id, pickup_zone, peak_hour,
       round(peak_trips / {days!r}, 2) AS avg_peak_hour_trips_per_calendar_day, monthly_trips,
       round(100.0 * monthly_trips / (SELECT count(*)::DOUBLE FROM enriched), 2) AS monthly_trip_share_pct
FROM (SELECT origin_id, pickup_zone, count(*) AS monthly_trips,
             row_number() OVER (ORDER BY count(*) DESC, origin_id, pickup_zone) AS zone_rank
      FROM enriched GROUP BY 1, 2) ranked
JOIN (SELECT origin_id, {HOUR}::INTEGER AS peak_hour, count(*)::DOUBLE AS peak_trips FROM enriched GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY origin_id ORDER BY count(*) DESC, {HOUR}::INTEGER) = 1) peaks
USING (origin_id)
WHERE zone_rank <= 5"""


PRIORITY = priority(365.0)

SEGMENTS = f"""
SELECT CASE origin_id WHEN 3 THEN 'Hub three' WHEN 8 THEN 'Hub eight' ELSE 'Other origins' END AS pickup_segment,
       count(*) AS total_trips, round({total("total_amount")} / count(total_amount), 2) AS avg_recorded_payment_usd,
       round({total("trip_duration_minutes")} / count(trip_duration_minutes), 2) AS avg_trip_minutes,
       round({total("distance")} / count(distance), 2) AS avg_trip_miles,
       round({total("total_amount")}, 2) AS total_recorded_payment_usd
FROM enriched GROUP BY 1"""

SUMMARY = f"""
SELECT count(*) AS eligible_trips, {total("total_amount")} AS recorded_payments,
       {total("total_amount")} / count(total_amount) AS avg_payment, {total("trip_duration_minutes")} / count(trip_duration_minutes) AS avg_minutes,
       count(*) - count(party_size) AS missing_passenger_count,
       (SELECT count(*) FROM staged) AS period_source_trips,
       100.0 * (SELECT sum(n)::DOUBLE FROM (SELECT count(*) AS n FROM enriched GROUP BY pickup_zone, pickup_borough
                                            ORDER BY n DESC LIMIT 15)) / count(*)::DOUBLE AS top15_share_pct
FROM enriched"""


# --- checks ---------------------------------------------------------------------------------------------


def shown(x: str) -> str:
    """A value with six places, rounded from its shortest text."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,6))"


def check_list(suite: str, source: str, checks: list[tuple[str, str, str, str]]) -> str:
    """(name, actual, expected, tolerance) over a one-row source, unnested into rows."""
    structs = ",\n    ".join(
        f"{{'o': {i}, 'n': '{name}', 'a': {shown(a)}, 'e': {shown(e)}, 't': {shown(t)}}}"
        for i, (name, a, e, t) in enumerate(checks, start=1)
    )
    return f"""
SELECT '{suite}' AS suite, CAST(c.o AS INTEGER) AS check_order, c.n AS check_name, c.a::DOUBLE AS actual_value,
       c.e::DOUBLE AS expected_value, c.t::DOUBLE AS tolerance, CAST(c.a - c.e AS DOUBLE) AS difference,
       CASE WHEN abs(c.a - c.e) <= c.t THEN 'PASS' ELSE 'FAIL' END AS check_status
FROM (SELECT unnest([{structs}]) AS c FROM {source})"""


STAGING_CHECKS = (
    """
s AS (
  SELECT count(*) AS n, count_if(is_valid_completed_trip) AS ok, count_if(NOT is_valid_completed_trip) AS bad,
         count_if(is_valid_completed_trip IS NULL) AS unknown,
         count_if(pickup_ts IS NULL OR year(pickup_ts) <> 1998) AS outside,
         count_if(is_valid_completed_trip AND has_nonpositive_duration) AS f1,
         count_if(is_valid_completed_trip AND has_nonpositive_distance) AS f2,
         count_if(is_valid_completed_trip AND has_excessive_distance) AS f3,
         count_if(is_valid_completed_trip AND has_invalid_amount) AS f4,
         count_if(NOT is_valid_completed_trip AND NOT (has_nonpositive_duration OR has_nonpositive_distance
                  OR has_excessive_distance OR has_invalid_amount)) AS f5
  FROM staged),
r AS (SELECT count_if(year(pickup_ts) = 1998) AS raw_rows FROM trips)""",
    check_list(
        "staging",
        "s, r",
        [
            ("Staging rows match raw Period rows", "n", "raw_rows", "0"),
            ("Valid plus invalid rows match staging rows", "ok + bad", "n", "0"),
            ("Rows with null validity classification", "unknown", "0", "0"),
            ("Staging rows outside Period", "outside", "0", "0"),
            ("Valid rows with nonpositive duration", "f1", "0", "0"),
            ("Valid rows with nonpositive distance", "f2", "0", "0"),
            ("Valid rows with distance above 45 units", "f3", "0", "0"),
            ("Valid rows with invalid amount", "f4", "0", "0"),
            ("Invalid rows without a quality flag", "f5", "0", "0"),
        ],
    ),
)

ENRICHED_CHECKS = (
    """
m AS (
  SELECT count(*) AS n, count_if(year(pickup_ts) <> 1998) AS outside, count_if(NOT is_valid_completed_trip) AS ineligible,
         count_if(distance IS NULL OR NOT distance BETWEEN 0.5 AND 45) AS off_distance,
         count_if(dropoff_ts <= pickup_ts) AS off_duration, count_if(total_amount <= 0 OR fare_amount < 0) AS off_amount,
         count_if(pickup_zone IS NULL) AS no_a, count_if(dropoff_zone IS NULL) AS no_b
  FROM enriched),
k AS (SELECT count(location_id) - count(DISTINCT location_id) AS twice FROM places),
v AS (SELECT count_if(is_valid_completed_trip) AS valid_rows FROM staged),
w AS (
  SELECT count_if(a.location_id IS NULL OR (pickup_zone, pickup_borough) IS DISTINCT FROM (a.zone, a.borough)) AS wrong_a,
         count_if(b.location_id IS NULL OR (dropoff_zone, dropoff_borough) IS DISTINCT FROM (b.zone, b.borough)) AS wrong_b
  FROM enriched LEFT JOIN places a ON a.location_id = origin_id LEFT JOIN places b ON b.location_id = dest_id)""",
    check_list(
        "enriched",
        "m, k, v, w",
        [
            ("Enriched row count matches valid staging count", "n", "valid_rows", "0"),
            ("Enriched rows outside Period", "outside", "0", "0"),
            ("Invalid trips present in enriched", "ineligible", "0", "0"),
            ("Enriched trips violating distance rules", "off_distance", "0", "0"),
            ("Enriched trips with nonpositive duration", "off_duration", "0", "0"),
            ("Enriched trips with invalid amounts", "off_amount", "0", "0"),
            ("Enriched trips with null pickup zone", "no_a", "0", "0"),
            ("Enriched trips with null dropoff zone", "no_b", "0", "0"),
            ("Duplicate location IDs in lookup", "twice", "0", "0"),
            ("Pickup labels match pickup location ID", "wrong_a", "0", "0"),
            ("Dropoff labels match dropoff location ID", "wrong_b", "0", "0"),
        ],
    ),
)

TOTALS = f"""
src AS (
  SELECT count(*) AS src_n, {total("fare_amount")} AS src_f, {total("total_amount")} AS src_t, sum(party_size) AS src_p,
         {total("distance")} AS src_d, {total("trip_duration_minutes")} AS src_m, count_if(origin_id = dest_id) AS src_same,
         count_if(origin_id <> dest_id) AS src_cross, min(pickup_date) AS first_date, max(pickup_date) AS last_date,
         count(DISTINCT pickup_date) AS src_dates, count(DISTINCT (pickup_zone, pickup_borough)) AS src_zones,
         count(DISTINCT {HOUR}) AS src_hours, count(DISTINCT ({HOUR}, pickup_zone, pickup_borough)) AS src_cells,
         count(DISTINCT (pickup_zone, dropoff_zone, {CATEGORY})) AS src_routes
  FROM enriched)"""


def money(x: str) -> str:
    return total(x)


DAILY_CHECKS = (
    f"""{TOTALS},
mart AS ({DAILY}),
own AS (SELECT count(*) AS n, count(DISTINCT pickup_date) AS k, sum(daily_trip_count) AS trips,
               {money("total_metered_fares")} AS f, {money("total_passenger_amount_paid")} AS t,
               sum(total_passengers) AS p FROM mart),
bad AS (SELECT count_if((avg_passenger_amount IS NULL) <> (x IS NULL) OR abs(avg_passenger_amount - x) > 0.000001) AS wrong
        FROM mart JOIN (SELECT pickup_date, avg(party_size) AS x FROM enriched GROUP BY 1) USING (pickup_date))""",
    check_list(
        "daily",
        "own, src, bad",
        [
            ("Daily trip counts reconcile to enriched trips", "trips", "src_n", "0"),
            ("Daily metered fares reconcile to enriched trips", "f", "src_f", "0.01"),
            ("Daily passenger amounts reconcile to enriched trips", "t", "src_t", "0.01"),
            ("Daily reported passengers reconcile to enriched trips", "p", "src_p", "0"),
            ("Daily result contains one row per observed date", "n", "src_dates", "0"),
            ("Daily result has no duplicate dates", "n - k", "0", "0"),
            ("Daily passenger averages match enriched trips", "wrong", "0", "0"),
        ],
    ),
)

ZONE_CHECKS = (
    f"""{TOTALS},
mart AS ({ZONES}),
own AS (SELECT count(*) AS n, count(DISTINCT (pickup_zone, pickup_borough)) AS k, sum(total_trip_count) AS trips,
               {money("total_metered_fares")} AS f, {money("total_passenger_amount_paid")} AS t,
               sum(total_passengers) AS p FROM mart),
bad AS (SELECT count_if(avg_passenger_per_trip IS DISTINCT FROM x) AS wrong
        FROM mart JOIN (SELECT pickup_zone AS z, pickup_borough AS b,
                               round(sum(party_size)::DOUBLE / nullif(count(party_size), 0), 2) AS x
                        FROM enriched GROUP BY 1, 2)
        ON z IS NOT DISTINCT FROM pickup_zone AND b IS NOT DISTINCT FROM pickup_borough)""",
    check_list(
        "zones",
        "own, src, bad",
        [
            ("Zone trips reconcile", "trips", "src_n", "0"),
            ("Zone metered fares reconcile (rounded by zone)", "f", "src_f", "src_zones * 0.005 + 0.01"),
            ("Zone passenger amounts reconcile (rounded by zone)", "t", "src_t", "src_zones * 0.5 + 0.01"),
            ("Zone reported passengers reconcile", "p", "src_p", "0"),
            ("One result row per zone and borough", "n", "src_zones", "0"),
            ("No duplicate zone and borough keys", "n - k", "0", "0"),
            ("Passenger averages use reported-trip denominator", "wrong", "0", "0"),
        ],
    ),
)

HOUR_CHECKS = (
    f"""{TOTALS},
mart AS ({HOURLY}),
own AS (SELECT count(*) AS n, count(DISTINCT pickup_hour) AS k, sum(total_trips) AS trips,
               sum(total_reported_passengers) AS p, {money("total_metered_fares")} AS f,
               {money("total_passenger_amount")} AS t FROM mart),
direct AS (SELECT {HOUR} AS pickup_hour, count(DISTINCT pickup_date) AS days, count(*) AS trips,
                  count(party_size) AS reported, {total("total_amount")} AS t, {total("distance")} AS d, {total("trip_duration_minutes")} AS m
           FROM enriched GROUP BY 1),
bad AS (SELECT count_if((days_observed, avg_daily_trips, passenger_count_coverage_pct, avg_passenger_amount_per_trip,
                         avg_trip_distance_miles, avg_trip_duration_minutes)
                        IS DISTINCT FROM
                        (days, round(trips::DOUBLE / days, 2), round(100.0 * reported::DOUBLE / trips::DOUBLE, 2),
                         round(t / trips, 2), round(d / trips, 2), round(m / trips, 2))) AS wrong
        FROM mart JOIN direct USING (pickup_hour))""",
    check_list(
        "hourly",
        "own, src, bad",
        [
            ("Hourly trips reconcile", "trips", "src_n", "0"),
            ("Hourly reported passengers reconcile", "p", "src_p", "0"),
            ("Hourly metered fares reconcile (rounded by hour)", "f", "src_f", "src_hours * 0.005 + 0.01"),
            ("Hourly passenger amounts reconcile (rounded by hour)", "t", "src_t", "src_hours * 0.005 + 0.01"),
            ("One result row per observed hour", "n", "src_hours", "0"),
            ("No duplicate hours", "n - k", "0", "0"),
            ("Hourly denominators and averages match source", "wrong", "0", "0"),
        ],
    ),
)

ZONE_HOUR_CHECKS = (
    f"""{TOTALS},
cells AS ({ZONE_HOUR_DETAIL}),
mart AS ({ZONE_HOURS}),
own AS (SELECT count(*) AS n, count(DISTINCT (pickup_date, pickup_hour, pickup_borough, pickup_zone)) AS k,
               sum(trips_in_hour) AS trips, sum(hourly_passenger_count) AS p, {money("hourly_passenger_amount")} AS t,
               {money("hourly_trip_distance")} AS d, {money("hourly_trip_duration_minutes")} AS m FROM cells),
res AS (SELECT count(*) AS rn, count(DISTINCT (pickup_hour_of_the_day, pickup_borough, pickup_zone)) AS rk FROM mart),
days AS (SELECT pickup_hour AS h, pickup_borough AS b, pickup_zone AS z, avg(trips_in_hour) AS a1,
                avg(hourly_passenger_count) AS a2, avg(hourly_passenger_amount) AS a3, avg(hourly_trip_distance) AS a4,
                avg(hourly_trip_duration_minutes) AS a5 FROM cells GROUP BY 1, 2, 3),
bad AS (SELECT count_if(greatest(abs(avg_trips_per_active_day - a1), abs(avg_reported_passengers_per_active_day - a2),
                                 abs(avg_passenger_amount_per_active_day - a3), abs(avg_trip_miles_per_active_day - a4),
                                 abs(avg_trip_minutes_per_active_day - a5)) > 0.500001
                        OR (avg_reported_passengers_per_active_day IS NULL) <> (a2 IS NULL)) AS wrong
        FROM mart JOIN days ON h = pickup_hour_of_the_day AND z IS NOT DISTINCT FROM pickup_zone
                           AND b IS NOT DISTINCT FROM pickup_borough)""",
    check_list(
        "zone_hourly",
        "own, res, src, bad",
        [
            ("Zone-hour underlying trips reconcile", "trips", "src_n", "0"),
            ("Zone-hour reported passengers reconcile", "p", "src_p", "0"),
            ("Zone-hour passenger amounts reconcile", "t", "src_t", "0.01"),
            ("Zone-hour trip distance reconciles", "d", "src_d", "0.01"),
            ("Zone-hour trip duration reconciles", "m", "src_m", "0.01"),
            ("No duplicate date-zone-hour keys", "n - k", "0", "0"),
            ("One result row per zone and hour", "rn", "src_cells", "0"),
            ("No duplicate zone-hour result keys", "rn - rk", "0", "0"),
            ("Zone-hour active-day averages match inputs", "wrong", "0", "0"),
        ],
    ),
)

ROUTE_CHECKS = (
    f"""{TOTALS},
detail AS ({ROUTE_TOTALS}),
mart AS ({ROUTE_AVERAGES}),
own AS (SELECT count(*) AS n, count(DISTINCT (pickup_zone, dropoff_zone, route_category)) AS k,
               sum(route_total_trips) AS trips, {money("route_total_amount")} AS t,
               {money("route_total_trip_distance")} AS d, {money("route_total_trip_duration")} AS m,
               sum(CASE WHEN route_category = 'Same-Zone' THEN route_total_trips END) AS same,
               sum(CASE WHEN route_category = 'Cross-Zone' THEN route_total_trips END) AS cross_trips FROM detail),
bad AS (SELECT count_if(x.route_total_trips <> y.route_total_trips
                        OR abs(avg_route_amount - route_total_amount / y.route_total_trips) > 0.005001
                        OR abs(avg_route_trip_distance - route_total_trip_distance / y.route_total_trips) > 0.005001
                        OR abs(avg_route_trip_duration - route_total_trip_duration / y.route_total_trips) > 0.500001) AS wrong
        FROM mart x JOIN detail y ON x.route_category = y.route_category
          AND x.pickup_zone IS NOT DISTINCT FROM y.pickup_zone AND x.dropoff_zone IS NOT DISTINCT FROM y.dropoff_zone)""",
    check_list(
        "routes",
        "own, src, bad",
        [
            ("Route trips reconcile", "trips", "src_n", "0"),
            ("Route passenger amounts reconcile", "t", "src_t", "0.01"),
            ("Route trip distances reconcile", "d", "src_d", "0.01"),
            ("Route trip durations reconcile", "m", "src_m", "0.01"),
            ("Same-zone routes reconcile by location ID", "same", "src_same", "0"),
            ("Cross-zone routes reconcile by location ID", "cross_trips", "src_cross", "0"),
            ("Route categories account for all trips", "same + cross_trips", "trips", "0"),
            ("One result row per route and category", "n", "src_routes", "0"),
            ("No duplicate route-category keys", "n - k", "0", "0"),
            ("Route averages match unrounded totals", "wrong", "0", "0"),
        ],
    ),
)

PRESENTATION_CHECKS = (
    f"""{TOTALS},
segments AS ({SEGMENTS}),
windows AS ({PRIORITY}),
seg AS (SELECT sum(total_trips) AS trips, {money("total_recorded_payment_usd")} AS t FROM segments),
win AS (SELECT count(*) AS n, count(DISTINCT pickup_location_id) AS k,
               count_if(abs(avg_peak_hour_trips_per_calendar_day - (
                   SELECT count(*) FROM enriched WHERE origin_id = pickup_location_id AND {HOUR} = peak_hour
               ) / 365.0) > 0.0051) AS wrong FROM windows)""",
    check_list(
        "presentation",
        "seg, win, src",
        [
            ("Airport segments preserve all eligible trips", "trips", "src_n", "0"),
            ("Airport payments reconcile", "t", "src_t", "0.02"),
            ("Exactly five priority zones", "n", "5", "0"),
            ("Priority zone IDs are unique", "k", "5", "0"),
            ("Period has the expected calendar span", "date_diff('day', first_date, last_date) + 1", "365", "0"),
            ("Peak averages use all 365 days", "wrong", "0", "0"),
        ],
    ),
)

SUITES = {
    "checks_staging": STAGING_CHECKS,
    "checks_enriched": ENRICHED_CHECKS,
    "checks_daily": DAILY_CHECKS,
    "checks_zones": ZONE_CHECKS,
    "checks_hourly": HOUR_CHECKS,
    "checks_zone_hourly": ZONE_HOUR_CHECKS,
    "checks_routes": ROUTE_CHECKS,
    "checks_presentation": PRESENTATION_CHECKS,
}


def query(base: str, select: str, *ctes: str) -> str:
    return "WITH " + ",".join((base, *ctes)).strip() + select


def suite(base: str, name: str) -> str:
    ctes, select = SUITES[name]
    return query(base, select, ctes)


def all_check_rows() -> str:
    """Every suite as a derived table of its own."""
    return " UNION ALL ".join(f"SELECT * FROM ({suite(MAIN, name)})" for name in SUITES)


EVENT_PAIR = "TIMESTAMP '2024-01-16 06:07:08.9', ts"
ACTIVE = "avg_trips_per_active_day"
WATCHED = "('NATION_3', 'NATION_8', 'NATION_12', 'NATION_15', 'NATION_20')"
GRID = ", ".join(
    f"max({ACTIVE}) FILTER (WHERE pickup_hour_of_the_day = {h}) AS h{h:02d}" for h in range(24)
)
TYPES = {"TIMESTAMP": "timestamp_ntz", "INTEGER": "int", "VARCHAR": "string"}
RAW_COLUMNS = (
    "l_orderkey l_partkey l_linenumber pickup_ts dropoff_ts origin_id dest_id distance fare_amount total_amount party_size"
).split()


def schema_profile() -> str:
    entries = ", ".join(
        f"{{'c': '{c}', 't': any_value(typeof({c})), 'n': count(*) - count({c})}}" for c in RAW_COLUMNS
    )
    spelled = " ".join(f"WHEN '{duck}' THEN '{spark}'" for duck, spark in TYPES.items())
    return f"""
SELECT p.c AS column_name, CASE p.t {spelled} ELSE lower(p.t) END AS column_type, p.n AS null_count
FROM (SELECT unnest([{entries}]) AS p FROM trips)"""


ORACLE: dict[str, str] = {
    "profile_schema": query(TRIPS, schema_profile()),
    "profile_raw": query(
        TRIPS,
        """
SELECT count(*) AS total_trips, min(pickup_ts) AS earliest_pickup, max(pickup_ts) AS latest_pickup,
       round(avg(distance), 2) AS avg_trip_distance, round(avg(total_amount)::DOUBLE, 2) AS avg_amount FROM trips""",
    ),
    "profile_period": query(
        TRIPS,
        """
SELECT count(*) AS total_rows, count_if(year(pickup_ts) < 1998) AS trips_before_period,
       count_if(year(pickup_ts) > 1998) AS trips_after_period, count_if(year(pickup_ts) = 1998) AS valid_period_trips
FROM trips""",
    ),
    "profile_quality": query(
        GAPPY_TRIPS,
        """
SELECT count(*) AS total_rows, count(*) - count(pickup_ts) AS no_pickup_count,
       count(*) - count(dropoff_ts) AS no_dropoff_count, count_if(pickup_ts = dropoff_ts) AS zero_trip_duration_count,
       count_if(pickup_ts > dropoff_ts) AS negative_trip_duration_count,
       count_if(NOT distance > 0) AS trip_dist_0_or_neg_count, count_if(fare_amount < 0) AS negative_fare_count,
       count_if(total_amount < 0) AS neg_total_amount_count, count(*) - count(origin_id) AS no_origin_id_count,
       count(*) - count(dest_id) AS no_dest_id_count FROM trips""",
    ),
    "lookup_csv": query(PLACES, "\nSELECT location_id, borough, zone, 'N/A' AS service_zone FROM places"),
    "view_query": query(
        MAIN,
        f"""
SELECT zone_rank, pickup_zone, peak_hour, total_trip_count, total_metered_fares
FROM ({PRIORITY}) JOIN ({ZONES}) USING (pickup_zone)""",
    ),
    "staged_trips": query(",".join((TRIPS, staged())), "\nSELECT * FROM staged"),
    "staged_gappy": query(",".join((GAPPY_TRIPS, staged())), "\nSELECT * FROM staged"),
    "enriched_trips": query(MAIN, "\nSELECT * FROM enriched"),
    "enriched_gappy": query(GAPPY, "\nSELECT * FROM enriched"),
    "duration_seconds": f"""
SELECT event_id, date_diff('second', {EVENT_PAIR}) AS seconds,
       round(date_diff('second', {EVENT_PAIR}) / 60.0, 2) AS minutes FROM events""",
    "duration_text": """
SELECT event_id, CAST(ts - TIMESTAMP '2024-01-16 06:07:08.9' AS VARCHAR) AS elapsed,
       epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-16 06:07:08.9') AS micros FROM events""",
    "daily_demand": query(MAIN, DAILY),
    "zone_performance": query(MAIN, ZONES),
    "hourly_demand": query(MAIN, HOURLY),
    "zone_hour_detail": query(MAIN, ZONE_HOUR_DETAIL),
    "zone_hour_performance": query(MAIN, ZONE_HOURS),
    "route_totals": query(MAIN, ROUTE_TOTALS),
    "route_averages": query(MAIN, ROUTE_AVERAGES),
    "priority_windows": query(MAIN, PRIORITY),
    "segment_comparison": query(MAIN, SEGMENTS),
    "daily_gappy": query(GAPPY, DAILY),
    "zone_gappy": query(GAPPY, ZONES),
    "zone_hour_gappy": query(GAPPY, ZONE_HOURS),
    "route_gappy": query(GAPPY, ROUTE_TOTALS),
    "segment_gappy": query(GAPPY, SEGMENTS),
    "priority_gappy": query(GAPPY, PRIORITY),
    "event_daily": query(EVENT, daily(lambda x: dbl(plain(x)))),
    "event_hourly": query(EVENT, hourly(plain, dbl)),
    "event_priority": query(EVENT, priority(14.0)),
    **{name: suite(MAIN, name) for name in SUITES},
    "checks_enriched_gappy": suite(GAPPY, "checks_enriched"),
    "checks_routes_gappy": suite(GAPPY, "checks_routes"),
    "check_gate": f"""
SELECT count(*) AS checks_run, count_if(check_status <> 'PASS') AS checks_failed,
       CASE WHEN count_if(check_status <> 'PASS') = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM ({all_check_rows()})""",
    "summary": query(MAIN, SUMMARY),
    "priority_table": query(
        MAIN,
        f"""
SELECT zone_rank || '. ' || pickup_zone AS "Priority_zone", format('{{:02d}}:00', peak_hour) AS "Peak_hour",
       format('{{:,.1f}}', avg_peak_hour_trips_per_calendar_day) AS "Pickups_per_day_in_peak_hour",
       format('{{:.2f}}%', monthly_trip_share_pct) AS "Monthly_trip_share", '' AS "Label" FROM ({PRIORITY})""",
    ),
    "segment_table": query(
        MAIN,
        f"""
SELECT pickup_segment AS "Pickup_area", format('{{:,}}', total_trips) AS "Period_trips",
       format('${{:,.2f}}', avg_recorded_payment_usd) AS "Payment_per_trip_USD",
       format('{{:.1f}}', avg_trip_minutes) AS "Minutes_per_trip", '' AS "Label" FROM ({SEGMENTS})""",
    ),
    "daily_line": query(MAIN, "\nSELECT pickup_date, count(*) AS daily_trip_count FROM enriched GROUP BY 1"),
    "hour_bars": query(MAIN, f"\nSELECT pickup_hour, avg_daily_trips FROM ({HOURLY})"),
    "zone_hour_heatmap": query(
        MAIN, f"\nSELECT pickup_zone, {GRID} FROM ({ZONE_HOURS}) WHERE pickup_zone IN {WATCHED} GROUP BY 1"
    ),
    "top_zones": query(
        MAIN,
        """
SELECT pickup_zone, count(*) AS total_trip_count FROM enriched
GROUP BY 1 ORDER BY total_trip_count DESC, pickup_zone LIMIT 15""",
    ),
    "borough_share": query(
        MAIN,
        """
SELECT pickup_borough, count(*) AS trips,
       round(100.0 * count(*)::DOUBLE / (SELECT count(*)::DOUBLE FROM enriched), 2) AS share_pct
FROM enriched GROUP BY 1""",
    ),
    "missing_share": query(
        MAIN,
        """
SELECT count(*) AS eligible_trips, count_if(party_size IS NULL) AS missing_passenger_count,
       round(100.0 * count_if(party_size IS NULL)::DOUBLE / count(*)::DOUBLE, 2) AS missing_pct FROM enriched""",
    ),
    "week_over_week": query(
        MAIN,
        """
SELECT x.pickup_date, x.n AS daily_trip_count, y.n AS trips_week_before,
       round(100.0 * (x.n - y.n)::DOUBLE / y.n::DOUBLE, 2) AS change_pct
FROM per_day x JOIN per_day y ON y.pickup_date = x.pickup_date - 7""",
        "\nper_day AS (SELECT pickup_date, count(*) AS n FROM enriched GROUP BY 1)",
    ),
    "daily_rejections": query(
        ",".join((TRIPS, staged())),
        """
SELECT pickup_ts::DATE AS pickup_date, count(*) AS source_trips, count_if(is_valid_completed_trip) AS eligible_trips,
       round(100.0 * count_if(NOT is_valid_completed_trip)::DOUBLE / count(*)::DOUBLE, 2) AS rejected_pct
FROM staged GROUP BY 1""",
    ),
    "hours_per_date": query(
        MAIN, f"\nSELECT pickup_date, count(DISTINCT {HOUR}) AS hours_observed FROM enriched GROUP BY 1"
    ),
    "zone_peak_active": query(
        MAIN,
        f"""
SELECT pickup_zone, pickup_borough, pickup_hour_of_the_day, {ACTIVE} FROM ({ZONE_HOURS}) WHERE pickup_zone IN {WATCHED}
QUALIFY row_number() OVER (PARTITION BY pickup_zone, pickup_borough ORDER BY {ACTIVE} DESC, pickup_hour_of_the_day) = 1""",
    ),
    "hour_leaders": query(
        MAIN,
        f"""
SELECT pickup_hour_of_the_day, pickup_zone, pickup_borough, {ACTIVE} FROM ({ZONE_HOURS})
QUALIFY row_number() OVER (PARTITION BY pickup_hour_of_the_day ORDER BY {ACTIVE} DESC, pickup_zone, pickup_borough) = 1""",
    ),
    "segment_vs_all": query(
        MAIN,
        f"""
SELECT pickup_segment, avg_recorded_payment_usd,
       (SELECT round({total("total_amount")} / count(total_amount), 2) FROM enriched) AS all_trips_payment_usd, avg_trip_minutes,
       (SELECT round({total("trip_duration_minutes")} / count(trip_duration_minutes), 2) FROM enriched) AS all_trips_minutes
FROM ({SEGMENTS})""",
    ),
    "hour_extremes": query(
        MAIN,
        """
SELECT (SELECT pickup_hour FROM mart ORDER BY avg_daily_trips DESC, pickup_hour LIMIT 1) AS busiest_hour,
       max(avg_daily_trips) AS busiest_avg_trips,
       (SELECT pickup_hour FROM mart ORDER BY avg_daily_trips, pickup_hour LIMIT 1) AS quietest_hour,
       min(avg_daily_trips) AS quietest_avg_trips FROM mart""",
        f"\nmart AS ({HOURLY})",
    ),
    "coverage_info": query(
        GAPPY,
        """
SELECT count(*) AS eligible_trips,
       count_if(pickup_zone = 'NATION_24' OR dropoff_zone = 'NATION_24') AS outside_zone_trips,
       count_if(party_size IS NULL) AS missing_passenger_count FROM enriched""",
    ),
    "distinct_tuples": query(
        GAPPY,
        """
SELECT count(DISTINCT (pickup_zone, pickup_borough, dropoff_zone)) AS label_tuples,
       count(DISTINCT {'z': pickup_zone}) AS zones_with_unknown, count(DISTINCT pickup_zone) AS zones FROM enriched""",
    ),
    "distinct_counts": query(
        MAIN,
        """
SELECT pickup_zone, count(l_orderkey) AS trips, count(l_orderkey) - count(DISTINCT l_orderkey) AS repeated_orders,
       min(pickup_ts) AS first_pickup, max(pickup_date) AS last_date FROM enriched GROUP BY 1""",
    ),
    "filtered_sums": query(
        GAPPY,
        f"""
SELECT pickup_borough, count(*) FILTER (origin_id = dest_id) AS same_zone_trips,
       {total("total_amount", "origin_id = dest_id")} AS same_zone_amount,
       {total("total_amount", "coalesce(origin_id <> dest_id, TRUE)")} AS cross_zone_amount,
       {big("sum(party_size) FILTER (distance > 40)")} AS far_party
FROM enriched GROUP BY 1""",
    ),
    "null_safe_join": query(
        GAPPY,
        """
SELECT o.zone, o.borough, pickups, dropoffs, known_dropoffs
FROM (SELECT pickup_zone AS zone, pickup_borough AS borough, count(*) AS pickups FROM enriched GROUP BY 1, 2) o
JOIN (SELECT dropoff_zone AS zone, dropoff_borough AS borough, count(*) AS dropoffs, count(dest_id) AS known_dropoffs
      FROM enriched GROUP BY 1, 2) i
ON o.zone IS NOT DISTINCT FROM i.zone AND o.borough IS NOT DISTINCT FROM i.borough""",
    ),
    "correlated_count": query(
        MAIN,
        f"""
SELECT location_id, zone, (SELECT count(*) FROM enriched
                           WHERE origin_id = location_id AND dest_id = location_id AND {HOUR} = 4) AS trips_in_hour_4
FROM places""",
    ),
    "export_csv": query(MAIN, HOURLY),
    "evidence_json": query(
        MAIN,
        f"""
SELECT unnest(['summary', 'quality_checks', 'daily_demand_revenue', 'hourly_demand', 'zone_performance',
               'zone_hourly_performance', 'priority_windows', 'airport_comparison']) AS dataset,
       unnest([1, 66, count(DISTINCT pickup_date), count(DISTINCT {HOUR}), count(DISTINCT (pickup_zone, pickup_borough)),
               count(DISTINCT ({HOUR}, pickup_zone, pickup_borough)), 5,
               count(DISTINCT CASE WHEN origin_id IN (3, 8) THEN origin_id ELSE -1 END)]) AS documents,
       'PASS' AS evidence_status
FROM enriched""",
    ),
    "verified_extract": query(
        MAIN,
        f"""
SELECT count(DISTINCT ({HOUR}, pickup_zone, pickup_borough)) AS rows_stored,
       count(DISTINCT ({HOUR}, pickup_zone, pickup_borough)) AS rows_expected, 'PASS' AS extract_status FROM enriched""",
    ),
    "export_contract": query(
        MAIN,
        f"""
SELECT count(DISTINCT (pickup_zone, dropoff_zone, {CATEGORY})) AS rows_read, CAST(0 AS BIGINT) AS rows_broken,
       'PASS' AS contract_status FROM enriched""",
    ),
    # a refresh publishes what the queries above compute
    "refresh_stopped": query(
        REFRESHED, "\nSELECT 1 AS version, count(*) AS eligible_trips, TRUE AS stopped, 0 AS folders_left FROM enriched"
    ),
    "published_positions": query(
        REFRESHED,
        f"""
SELECT 'daily_demand_revenue' AS dataset, row_number() OVER (ORDER BY pickup_date) - 1 AS position, pickup_date::VARCHAR AS sort_key
FROM (SELECT DISTINCT pickup_date FROM enriched)
UNION ALL
SELECT 'hourly_demand', row_number() OVER (ORDER BY h) - 1, h::VARCHAR FROM (SELECT DISTINCT {HOUR} AS h FROM enriched)
UNION ALL
SELECT 'zone_performance', row_number() OVER (ORDER BY n DESC, pickup_zone NULLS LAST, pickup_borough NULLS LAST) - 1,
       n || '|' || coalesce(pickup_zone, '-') || '|' || coalesce(pickup_borough, '-')
FROM (SELECT pickup_zone, pickup_borough, count(*) AS n FROM enriched GROUP BY ALL)
UNION ALL
SELECT 'zone_hourly_performance', row_number() OVER (ORDER BY pickup_zone NULLS LAST, h, pickup_borough NULLS LAST) - 1,
       coalesce(pickup_zone, '-') || '|' || h || '|' || coalesce(pickup_borough, '-')
FROM (SELECT DISTINCT pickup_zone, {HOUR} AS h, pickup_borough FROM enriched)
UNION ALL
SELECT 'airport_comparison', row_number() OVER (ORDER BY s) - 1, s
FROM (SELECT DISTINCT CASE origin_id WHEN 3 THEN 'Hub three' WHEN 8 THEN 'Hub eight' ELSE 'Other origins' END AS s FROM enriched)""",
    ),
}


def one_sided(report: str, groups: str, keys: dict[str, str]) -> str:
    """Keys of one side only, counted by two set differences, in which nulls are equal."""
    shown, known = f"SELECT {', '.join(keys)} FROM ({report})", f"SELECT {groups} FROM enriched"
    return f"((SELECT count(*) FROM ({shown} EXCEPT {known})) + (SELECT count(*) FROM ({known} EXCEPT {shown})))"


COMPLETENESS = (
    f"""counted AS (
  SELECT {one_sided(DAILY, "pickup_date", {"pickup_date": ""})} AS d,
         {one_sided(ZONES, "pickup_zone, pickup_borough", {"pickup_zone": "", "pickup_borough": ""})} AS z,
         {one_sided(HOURLY, HOUR, {"pickup_hour": ""})} AS h,
         {one_sided(ZONE_HOUR_DETAIL, f"pickup_date, {HOUR}, pickup_borough, pickup_zone", {"pickup_date": "", "pickup_hour": "", "pickup_borough": "", "pickup_zone": ""})} AS c,
         {one_sided(ZONE_HOURS, f"{HOUR}, pickup_borough, pickup_zone", {"pickup_hour_of_the_day": "", "pickup_borough": "", "pickup_zone": ""})} AS p,
         {one_sided(ROUTE_AVERAGES, f"pickup_zone, dropoff_zone, {CATEGORY}", {"pickup_zone": "", "dropoff_zone": "", "route_category": ""})} AS r)""",
    check_list(
        "completeness",
        "counted",
        [
            ("Dates in the report or in the trips only", "d", "0", "0"),
            ("Zones in the report or in the trips only", "z", "0", "0"),
            ("Hours in the report or in the trips only", "h", "0", "0"),
            ("Date-zone-hours in the report or in the trips only", "c", "0", "0"),
            ("Zone-hours in the report or in the trips only", "p", "0", "0"),
            ("Routes in the report or in the trips only", "r", "0", "0"),
        ],
    ),
)
ORACLE["checks_completeness"] = query(MAIN, COMPLETENESS[1], COMPLETENESS[0])
ORACLE["checks_completeness_gappy"] = query(GAPPY, COMPLETENESS[1], COMPLETENESS[0])
ORACLE["refresh_enriched"] = query(REFRESHED, "\nSELECT * FROM enriched")
ORACLE["refresh_reports"] = query(REFRESHED, ZONE_HOURS)
