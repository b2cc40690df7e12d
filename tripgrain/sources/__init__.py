"""Readers for the trip table and the location lookup."""

from tripgrain.sources.lookup import bounded, read_lookup
from tripgrain.sources.trips import read_trips, require_columns

__all__ = ["bounded", "read_lookup", "read_trips", "require_columns"]
