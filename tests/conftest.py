import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripgrain.session import build_session
from tripgrain.spec import TripSpec

SMALL_SF = "/root/testdata/sf0.001"

# One week, so that a handful of trips can observe every day of the period.
WEEK = TripSpec(period_start=datetime(2026, 1, 5), period_end=datetime(2026, 1, 12), priority_zones=2, period_name="Week")

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
    ]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "4000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def moment(text):
    return datetime.fromisoformat(text) if text else None


def trip(
    pickup="2026-01-05 10:00:00",
    dropoff="2026-01-05 10:15:00",
    distance=2.0,
    fare=10.0,
    total=15.0,
    party=1,
    origin=1,
    dest=2,
):
    return (moment(pickup), moment(dropoff), distance, fare, total, party, origin, dest)


@pytest.fixture(scope="session")
def trips_of(spark):
    return lambda rows: spark.createDataFrame(rows, TRIP_SCHEMA)


@pytest.fixture(scope="session")
def places(spark, tmp_path_factory):
    """Six locations; 3 and 4 share a name and borough, 5 carries the literal label N/A."""
    rows = [
        (1, "Queens", "JFK Airport", "Airports"),
        (2, "Manhattan", "Midtown Center", "Yellow Zone"),
        (3, "Queens", "Corona", "Boro Zone"),
        (4, "Queens", "Corona", "Boro Zone"),
        (5, "N/A", "Outside of NYC", "N/A"),
        (6, "Manhattan", "East Village", "Yellow Zone"),
    ]
    path = str(tmp_path_factory.mktemp("places") / "places")  # stored, so that its size is known
    spark.createDataFrame(rows, WEEK.lookup_schema()).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def week_rows():
    """A week of trips with idle hours, unreported parties, shared names, ties and one dominant origin."""
    rows = []
    for day in range(5, 12):
        for i in range(12):
            hour = (i * 5 + day) % 24
            party = None if i % 3 == 0 else 1 + i % 4
            origin = 2 if i % 2 else 1 + (i + day) % 6
            dest = 1 + (i * day) % 6
            rows.append(
                trip(
                    f"2026-01-{day:02d} {hour:02d}:{i:02d}:00",
                    f"2026-01-{day:02d} {hour:02d}:{20 + i:02d}:{(i * 7) % 60:02d}",
                    distance=round(0.7 + 0.31 * i, 2),
                    fare=round(5 + 1.37 * i + 0.01 * day, 2),
                    total=round(8.05 + 1.99 * i + 0.03 * day, 2),
                    party=party,
                    origin=origin,
                    dest=dest,
                )
            )
    rows.append(trip("2026-01-06 10:00:00", "2026-01-06 09:00:00"))  # ends before it starts
    rows.append(trip("2026-01-06 10:00:00", "2026-01-06 10:09:00", distance=501.0))
    rows.append(trip("2026-01-12 00:00:00", "2026-01-12 00:09:00"))  # first moment after the period
    return rows
