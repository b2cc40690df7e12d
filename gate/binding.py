"""Trip-shaped data derived from the test tables.

`lineitem`, `orders`, `customer` and `supplier` give the trips; `nation` and `region` the lookup.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.spec import TripSpec

SPEC = TripSpec(
    pickup_ts="pickup_ts",
    dropoff_ts="dropoff_ts",
    origin_id="origin_id",
    dest_id="dest_id",
    distance="distance",
    fare="fare_amount",
    total="total_amount",
    party="party_size",
    location_id="location_id",
    zone="zone",
    borough="borough",
    period_start=datetime(1998, 1, 1),
    period_end=datetime(1999, 1, 1),
    period_name="Period",
    max_distance=45.0,
    distance_unit="units",
    segments=((3, "Hub three"), (8, "Hub eight")),
    other_segment="Other origins",
    watched_zones=("NATION_3", "NATION_8", "NATION_12", "NATION_15", "NATION_20"),
    outside_zone="NATION_24",
)

# The period that is refreshed: its first and last day have trips at every scale, as the calendar check wants.
REFRESH_SPEC = replace(SPEC, period_start=datetime(1998, 3, 1))

# The second binding: events as point-like trips, for wall-clock times with microseconds.
EVENT_SPEC = replace(
    SPEC, period_start=datetime(2024, 1, 8), period_end=datetime(2024, 1, 22), max_distance=80.0
)


# Declared, so that opening a table starts no schema-inference job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str, within: TripSpec | None = None) -> DataFrame:
    """Trips of all years, or of the spec's period.

    Pickup depends on the order alone, so it is computed on the order side: the period filter of a
    consumer then moves below the join, and `within` adds the implied order-date range that Parquet can
    use to skip row groups. No side is hinted: customer and supplier grow with the data, so Spark compares
    their size with its broadcast threshold and otherwise shuffles, splitting skewed keys.
    """
    orders = table(spark, sf_dir, "orders")
    if within is not None:
        earliest = within.period_start - timedelta(days=1)
        orders = orders.where(
            (F.col("o_orderdate") > F.lit(earliest.isoformat(sep=" ")).cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.lit(within.period_end.isoformat(sep=" ")).cast("timestamp_ntz"))
        )
    booked = orders.select(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        after(F.col("o_orderdate"), F.col("o_orderkey") * 37 % 86400).alias("pickup_ts"),
    )
    riders = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("dest_id"))
    cabs = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("origin_id"))
    refunded = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    sign = F.when(refunded, -1.0).otherwise(1.0)
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .join(booked, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(riders, F.col("o_custkey") == F.col("c_custkey"))
        .join(cabs, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            "pickup_ts",
            after(F.col("pickup_ts"), F.col("l_partkey") * 101 % 7200 - 120).alias("dropoff_ts"),
            "origin_id",
            "dest_id",
            (F.col("l_quantity") - 2).alias("distance"),
            (sign * price).alias("fare_amount"),
            (sign * price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total_amount"),
            F.when(F.col("l_returnflag") != "N", F.col("l_linenumber")).alias("party_size"),
        )
    )


def after(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), ts)


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("location_id"), F.col("r_name").alias("borough"), F.col("n_name").alias("zone")
    )


def gappy_trips(spark: SparkSession, sf_dir: str, within: TripSpec | None = None) -> DataFrame:
    """The same trips with missing measures, times and locations."""
    trips = raw_trips(spark, sf_dir, within)
    return trips.withColumns(
        {
            "dropoff_ts": F.when(F.col("l_partkey") % 11 != 0, F.col("dropoff_ts")),
            "distance": F.nullif(F.col("distance"), F.lit(8.0)),
            "total_amount": F.when(F.col("l_linenumber") != 6, F.col("total_amount")),
            "fare_amount": F.when(F.col("l_linenumber") != 7, F.col("fare_amount")),
            "dest_id": F.nullif(F.col("dest_id"), F.lit(9)),
        }
    )


def short_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup without location 12, and with one name for locations 13 and 15."""
    rows = lookup(spark, sf_dir).where(F.col("location_id") != 12)
    return rows.withColumn("zone", F.when(F.col("location_id") == 15, "NATION_13").otherwise(F.col("zone"))).withColumn(
        "borough",
        F.when(F.col("location_id").isin(13, 15), "TWIN").otherwise(F.col("borough")),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips: `value` serves as minutes travelled, distance and price; the user's nation as both ends."""
    events = table(spark, sf_dir, "events")
    home = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    value = F.col("value").cast("decimal(18,6)")
    return events.join(home, F.col("user_id") == F.col("c_custkey")).select(
        "event_id",
        F.col("ts").alias("pickup_ts"),
        F.timestamp_add("MICROSECOND", F.rint(F.col("value") * 6e7 - 3e8).cast("bigint"), F.col("ts")).alias("dropoff_ts"),
        F.col("c_nationkey").alias("origin_id"),
        ((F.col("c_nationkey") + F.length("event_type")) % 25).alias("dest_id"),
        F.col("value").alias("distance"),
        value.cast("decimal(18,2)").alias("fare_amount"),
        (value - 5).cast("decimal(18,6)").alias("total_amount"),
        F.when(F.col("event_type") != "error", F.length("event_type")).alias("party_size"),
    )
