"""Register stages and reports as temporary views, to be queried with `spark.sql` under their usual names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripgrain.operators.enrich import LABELS, enrich
from tripgrain.operators.staging import clean_trips
from tripgrain.plans.marts import REPORTS, mart
from tripgrain.plans.refresh import read_enriched, read_staged
from tripgrain.sinks.manifest import current
from tripgrain.spec import TripSpec

# The names under which the two stages are queried.
STAGED_VIEW = "stg_yellow_trips"
ENRICHED_VIEW = "enriched_yellow_trips"


def register_published(spark: SparkSession, out: str, spec: TripSpec) -> list[str]:
    """The same views over what was published last. All of them read the version that is current now, also after another
    one is published, so a query never mixes two runs."""
    version = current(spark, out)
    enriched = read_enriched(spark, out, spec, version)
    flagged = read_staged(spark, out, spec, version).drop(*LABELS, "pickup_date")
    return _register({STAGED_VIEW: flagged, ENRICHED_VIEW: enriched, **{name: mart(name, enriched, spec) for name in REPORTS}})


def register_views(trips: DataFrame, lookup: DataFrame, spec: TripSpec) -> list[str]:
    """Create or replace all eleven views. They stay unmaterialised, like any view."""
    staged = clean_trips(trips, spec)
    enriched = enrich(staged, lookup, spec)
    return _register({STAGED_VIEW: staged, ENRICHED_VIEW: enriched, **{name: mart(name, enriched, spec) for name in REPORTS}})


def _register(views: dict[str, DataFrame]) -> list[str]:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
