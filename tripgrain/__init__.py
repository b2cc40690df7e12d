"""Trip-demand reports, checks and exports as Spark jobs."""

from tripgrain.spec import TripSpec

__all__ = ["TripSpec"]
