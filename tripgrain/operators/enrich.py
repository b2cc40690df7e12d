"""Attach location labels to the eligible trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.operators.staging import VALID
from tripgrain.sources.lookup import bounded
from tripgrain.spec import TripSpec

LABELS = ("pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough")


def label_side(lookup: DataFrame, spec: TripSpec, role: str) -> DataFrame:
    """The lookup for one role (`pickup` or `dropoff`), its key renamed so that joins cannot be ambiguous."""
    return lookup.select(
        F.col(spec.location_id).alias(f"{role}_key"),
        F.col(spec.zone).alias(f"{role}_zone"),
        F.col(spec.borough).alias(f"{role}_borough"),
    )


def attach(trips: DataFrame, lookup: DataFrame, spec: TripSpec, role: str, location: str) -> DataFrame:
    """Left join on location ID; a trip without a lookup row stays, with null labels."""
    side = label_side(lookup, spec, role)
    return trips.join(side, trips[location] == side[f"{role}_key"], "left").drop(f"{role}_key")


def label_trips(staged: DataFrame, lookup: DataFrame, spec: TripSpec) -> DataFrame:
    """Trips with zone and borough of both ends and the pickup date.

    With a lookup inside the broadcast bound both joins are hash joins on the mapper side and the trips
    are never shuffled.
    """
    small = bounded(lookup.select(spec.location_id, spec.zone, spec.borough))
    trips = attach(staged, small, spec, "pickup", spec.origin_id)
    trips = attach(trips, small, spec, "dropoff", spec.dest_id)
    return trips.withColumn("pickup_date", F.to_date(spec.pickup_ts))


def enrich(staged: DataFrame, lookup: DataFrame, spec: TripSpec) -> DataFrame:
    """The eligible trips, labelled."""
    return label_trips(staged.where(F.col(VALID)), lookup, spec)
