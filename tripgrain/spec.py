"""Everything a run may vary: column roles, reporting period, thresholds, labels.

All operators and plans take a `TripSpec`, so the same code serves any trip-shaped table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

# The published defaults of the trip-record schema, eligibility rules and report layout.
DEFAULT_SEGMENTS = ((132, "JFK Airport"), (138, "LaGuardia Airport"))
DEFAULT_OTHER_SEGMENT = "Other pickup zones"
DEFAULT_WATCHED_ZONES = (
    "East Village",
    "JFK Airport",
    "LaGuardia Airport",
    "Midtown Center",
    "Upper East Side South",
)
SAME_ZONE = "Same-Zone"
CROSS_ZONE = "Cross-Zone"


@dataclass(frozen=True)
class TripSpec:
    # column roles of the raw trip table
    pickup_ts: str = "tpep_pickup_datetime"
    dropoff_ts: str = "tpep_dropoff_datetime"
    origin_id: str = "PULocationID"
    dest_id: str = "DOLocationID"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    total: str = "total_amount"
    party: str = "passenger_count"

    # column roles of the location lookup
    location_id: str = "LocationID"
    zone: str = "Zone"
    borough: str = "Borough"

    # reporting period, half open
    period_start: datetime = datetime(2026, 1, 1)
    period_end: datetime = datetime(2026, 2, 1)
    period_name: str = "January"
    source: str = "trip records"  # what the evidence names as its source

    # eligibility and reporting rules
    max_distance: float = 500.0
    distance_unit: str = "miles"
    segments: tuple[tuple[int, str], ...] = DEFAULT_SEGMENTS
    other_segment: str = DEFAULT_OTHER_SEGMENT
    priority_zones: int = 5
    leading_zones: int = 15
    watched_zones: tuple[str, ...] = DEFAULT_WATCHED_ZONES
    outside_zone: str = "Outside of NYC"

    def __post_init__(self):
        if self.period_end <= self.period_start:
            raise ValueError("period_end must be later than period_start")
        if any(t != t.replace(hour=0, minute=0, second=0, microsecond=0) for t in (self.period_start, self.period_end)):
            raise ValueError("the period must start and end at midnight: reports count whole calendar days")

    @property
    def calendar_days(self) -> int:
        """Days of the period, with or without trips."""
        return (self.period_end - self.period_start).days

    @property
    def period_key(self) -> str:
        """The period's name as it appears inside column names."""
        return self.period_name.lower().replace(" ", "_")

    @property
    def trip_columns(self) -> tuple[str, ...]:
        return (
            self.pickup_ts,
            self.dropoff_ts,
            self.origin_id,
            self.dest_id,
            self.distance,
            self.fare,
            self.total,
            self.party,
        )

    def lookup_schema(self) -> T.StructType:
        """Declared schema of the location CSV; `N/A` is an ordinary label, not a null."""
        return T.StructType(
            [
                T.StructField(self.location_id, T.IntegerType()),
                T.StructField(self.borough, T.StringType()),
                T.StructField(self.zone, T.StringType()),
                T.StructField("service_zone", T.StringType()),
            ]
        )
