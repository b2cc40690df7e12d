"""The physical plans that make the jobs scale."""

from datetime import datetime
import re

import pytest
from conftest import SMALL_SF, WEEK, trip
from pyspark.sql import functions as F

from gate.queries import QUERIES
from tripgrain.operators import enrich as enrich_module
from tripgrain.operators.enrich import enrich
from tripgrain.operators.staging import clean_trips
from tripgrain.plans.marts import REPORTS, mart
from tripgrain.plans.refresh import gathered, read_enriched, read_staged, trips_schema, write_trips
from tripgrain.sinks import manifest
from tripgrain.spec import TripSpec


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, trips_of, week_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "trips")
    trips_of(week_rows).withColumn("unused", F.lit("x")).write.parquet(path)
    return spark.read.parquet(path)


def test_period_reaches_the_scan_and_unused_columns_do_not(stored, places):
    plan = physical(mart("daily_demand_revenue", enrich(clean_trips(stored, WEEK), places, WEEK), WEEK))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "LessThan(tpep_pickup_datetime" in pushed
    assert "unused" not in plan and "trip_duration_hms" not in plan


def test_lookup_joins_are_broadcast_and_trips_are_not_shuffled(stored, places):
    plan = physical(enrich(clean_trips(stored, WEEK), places, WEEK))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert "hashpartitioning" not in plan


def test_a_lookup_beyond_the_bound_is_shuffled_instead(spark, stored, places, monkeypatch):
    monkeypatch.setattr(enrich_module, "bounded", lambda df: df)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich(clean_trips(stored, WEEK), places, WEEK)
        assert physical(large).count("SortMergeJoin") == 2
        got = sorted(map(str, large.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    monkeypatch.undo()
    assert got == sorted(map(str, enrich(clean_trips(stored, WEEK), places, WEEK).collect()))


@pytest.mark.parametrize("name", list(REPORTS))
def test_reports_combine_before_they_shuffle(stored, places, name):
    plan = physical(mart(name, enrich(clean_trips(stored, WEEK), places, WEEK), WEEK))
    assert "partial_" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("name", ["daily_demand_revenue", "zone_performance", "route_analysis"])
def test_one_shuffle_per_simple_report(stored, places, name):
    plan = physical(mart(name, enrich(clean_trips(stored, WEEK), places, WEEK), WEEK))
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", list(REPORTS))
def test_each_report_reads_the_trips_once(spark, stored, places, name):
    # without adaptive execution the reuse of a shuffle shows in the plan before it runs
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical(mart(name, enrich(clean_trips(stored, WEEK), places, WEEK), WEEK))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert sum("tpep_pickup_datetime" in line for line in scans) == 1


def test_ranking_limits_before_numbering(stored, places):
    plan = physical(mart("priority_windows", enrich(clean_trips(stored, WEEK), places, WEEK), WEEK))
    assert "TakeOrderedAndProject" in plan


def test_peak_hours_keep_one_row_per_key_and_task(spark):
    plan = physical(QUERIES["hour_leaders"](spark, SMALL_SF))
    assert "WindowGroupLimit" in plan


def test_only_raw_columns_of_the_period_are_shuffled(stored):
    plan = physical(gathered(stored, WEEK))
    exchange, below = plan.split("REBALANCE_PARTITIONS_BY_COL", 1)
    assert "trip_duration" not in below and "Filter" in below and plan.count("Exchange") == 1


def test_stored_dates_are_pruned(spark, trips_of, places, tmp_path):
    out, wide = str(tmp_path / "out"), TripSpec(period_start=WEEK.period_start, period_end=datetime(2026, 1, 19))
    folder = manifest.fresh_folder(out)
    rows = trips_of([trip(), trip(distance=-1.0), trip("2026-01-13 10:00:00", "2026-01-13 10:30:00")])
    assert write_trips(rows, places, wide, folder) == 3
    manifest.publish(spark, out, trips_schema(rows, places, wide), manifest.written_partitions(spark, out, folder), lambda key: True, {}, None)
    read = read_enriched(spark, out, WEEK)
    # eligible trips of the week's one date: no other folder is named in the plan, and the period reaches the scan
    assert {f.rsplit("/", 2)[1] for f in read.inputFiles()} == {"part=2026-01-05"}
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in physical(read) and read.count() == 1
    assert read_staged(spark, out, wide).count() == 3


@pytest.mark.parametrize("name", ["checks_daily", "checks_zones", "checks_hourly", "checks_routes", "checks_presentation", "summary"])
def test_grand_totals_are_subqueries_not_joins(spark, name):
    plan = physical(QUERIES[name](spark, SMALL_SF))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_test_tables_filter_before_the_joins(spark):
    plan = physical(QUERIES["daily_demand"](spark, SMALL_SF))
    orders = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "GreaterThan(o_orderdate" in orders and "LessThan(o_orderdate" in orders
    assert "l_shipdate" not in plan and "o_totalprice" not in plan and "c_acctbal" not in plan
