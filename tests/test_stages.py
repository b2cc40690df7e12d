import pytest
from conftest import WEEK, moment, trip
from pyspark.sql import functions as F

from tripgrain.operators.enrich import enrich
from tripgrain.operators.staging import clean_trips
from tripgrain.plans.marts import mart
from tripgrain.sources import bounded, read_lookup, read_trips, require_columns
from tripgrain.sinks import write_csv
from tripgrain.spec import TripSpec

NAN = float("nan")


@pytest.mark.parametrize(
    "changes, valid",
    [
        ({}, True),
        ({"dropoff": "2026-01-05 10:00:00"}, False),
        ({"dropoff": "2026-01-05 09:59:59.999999"}, False),
        ({"dropoff": "2026-01-05 10:00:00.000001"}, True),
        ({"dropoff": None}, True),
        ({"distance": -1.0}, False),
        ({"distance": 0.0}, False),
        ({"distance": 500.0}, True),
        ({"distance": 500.01}, False),
        ({"distance": None}, True),
        ({"distance": NAN}, False),
        ({"total": 0.0}, False),
        ({"total": -1.0}, False),
        ({"total": None}, True),
        ({"fare": -0.01}, False),
        ({"fare": 0.0}, True),
        ({"fare": None}, True),
        ({"total": None, "fare": -1.0}, False),
        ({"total": 5.0, "fare": None}, True),
        ({"party": None}, True),
    ],
)
def test_validity(trips_of, changes, valid):
    row = clean_trips(trips_of([trip(**changes)]), WEEK).first()
    assert row.is_valid_completed_trip is valid
    flags = (row.has_nonpositive_duration, row.has_nonpositive_distance, row.has_excessive_distance, row.has_invalid_amount)
    assert any(flags) is not valid and None not in flags


@pytest.mark.parametrize(
    "pickup, kept",
    [
        ("2026-01-05 00:00:00", True),
        ("2026-01-04 23:59:59.999999", False),
        ("2026-01-11 23:59:59.999999", True),
        ("2026-01-12 00:00:00", False),
        (None, False),
    ],
)
def test_period_is_half_open(trips_of, pickup, kept):
    assert clean_trips(trips_of([trip(pickup, "2026-01-20 00:00:00")]), WEEK).count() == int(kept)


def test_staging_keeps_every_raw_column(trips_of):
    raw = trips_of([trip()]).withColumn("extra", F.lit("kept"))
    staged = clean_trips(raw, WEEK)
    assert staged.columns == [
        *raw.columns,
        "trip_duration_hms",
        "trip_duration_minutes",
        "has_nonpositive_duration",
        "has_nonpositive_distance",
        "has_excessive_distance",
        "has_invalid_amount",
        "is_valid_completed_trip",
    ]
    row = staged.first()
    assert (row.extra, row.trip_duration_hms, row.trip_duration_minutes) == ("kept", "00:15:00", 15.0)


def test_missing_dropoff_has_no_duration(trips_of):
    row = clean_trips(trips_of([trip(dropoff=None)]), WEEK).first()
    assert row.trip_duration_hms is None and row.trip_duration_minutes is None


def test_unmatched_locations_stay_with_null_labels(trips_of, places):
    rows = [trip(origin=99, dest=1), trip(origin=None, dest=None), trip(origin=1, dest=5)]
    got = enrich(clean_trips(trips_of(rows), WEEK), places, WEEK)
    labels = {(r.PULocationID, r.DOLocationID): (r.pickup_zone, r.dropoff_zone, r.dropoff_borough) for r in got.collect()}
    assert labels == {
        (99, 1): (None, "JFK Airport", "Queens"),
        (None, None): (None, None, None),
        (1, 5): ("JFK Airport", "Outside of NYC", "N/A"),
    }


def test_enriched_holds_only_valid_trips_with_their_date(trips_of, places):
    rows = [trip(), trip(total=0.0), trip("2026-01-07 23:59:59", "2026-01-08 00:30:00")]
    got = enrich(clean_trips(trips_of(rows), WEEK), places, WEEK)
    assert sorted(str(r.pickup_date) for r in got.collect()) == ["2026-01-05", "2026-01-07"]


def test_a_repeated_lookup_id_multiplies_trips(trips_of, places):
    twice = places.unionByName(places.where("LocationID = 1"))
    assert enrich(clean_trips(trips_of([trip(origin=1, dest=2)]), WEEK), twice, WEEK).count() == 2


def test_lookup_csv_keeps_its_literal_labels(spark, places, tmp_path):
    got = read_lookup(spark, write_csv(places, str(tmp_path / "lookup")), WEEK)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, places.collect()))


def test_lookup_with_another_header_is_refused(spark, places, tmp_path):
    path = write_csv(places.withColumnRenamed("Zone", "Area"), str(tmp_path / "lookup"))
    with pytest.raises(Exception, match="(?i)header"):
        read_lookup(spark, path, WEEK).collect()


def test_reader_takes_several_folders_and_names_missing_columns(spark, trips_of, tmp_path):
    for name in "ab":
        trips_of([trip()]).write.parquet(str(tmp_path / name))
    assert read_trips(spark, [str(tmp_path / "a"), str(tmp_path / "b")], WEEK).count() == 2
    with pytest.raises(ValueError, match="fare_amount"):
        require_columns(trips_of([trip()]).drop("fare_amount"), WEEK)


def test_zoned_times_are_taken_as_wall_clock(spark, trips_of):
    zoned = trips_of([trip()]).withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp"))
    assert require_columns(zoned, WEEK).first().tpep_pickup_datetime == moment("2026-01-05 10:00:00")


def test_broadcast_only_within_the_bound(places):
    assert "ResolvedHint" in places.sparkSession.createDataFrame([(1,)], "x int").hint("broadcast")._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in bounded(places)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in bounded(places, 5)._jdf.queryExecution().analyzed().toString()


def test_declaring_a_report_runs_no_job(spark, trips_of, places):
    trips = trips_of([trip()])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("declare", "")
    try:
        mart("daily_demand_revenue", enrich(clean_trips(trips, WEEK), places, WEEK), WEEK)
        assert not list(tracker.getJobIdsForGroup("declare"))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_spec_refuses_a_period_that_is_not_whole_days():
    with pytest.raises(ValueError, match="midnight"):
        TripSpec(period_start=moment("2026-01-05 06:00:00"), period_end=moment("2026-01-08"))


def test_spec_refuses_an_empty_period():
    with pytest.raises(ValueError):
        TripSpec(period_start=moment("2026-01-05"), period_end=moment("2026-01-05"))
    assert TripSpec().calendar_days == 31
