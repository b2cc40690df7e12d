"""The full refresh: stage, enrich, report, check, publish.

Raw trips are read once: the pass that writes the period's trips also counts them. Whole trips are shuffled once, to lay
the table out by date. Rejected trips are kept beside the eligible ones, in partitions of their own, so everything that
is said about staging comes from stored rows. The eligible trips are aggregated five times: place-and-hour totals and
route totals for the reports, the same two again for the checks, and label groups. Everything after that works on those
totals, which are smaller by orders of magnitude.

All files of a run lie in folders of its own. They become visible together, when the run's manifest is written as its
last step (`sinks.manifest`); a run that fails or is killed leaves the version before as it was.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripgrain.operators.checks import enforce
from tripgrain.operators.enrich import label_trips
from tripgrain.operators.staging import VALID, clean_trips, in_period
from tripgrain.operators.totals import PLACE_HOUR, ROUTE, trip_totals
from tripgrain.plans import published
from tripgrain.plans.marts import all_marts
from tripgrain.plans.suites import Evidence, all_checks, checks_completeness, expected_totals
from tripgrain.session import durable
from tripgrain.sinks import manifest
from tripgrain.sinks.datasets import contract_violations, verified_evidence, verified_extract, write_csv
from tripgrain.sinks.manifest import PART, Version
from tripgrain.spec import TripSpec

REJECTED = "rejected-"  # partitions of a date's rejected trips are named by this and the date


@dataclass(frozen=True)
class Refresh:
    enriched: DataFrame
    marts: dict[str, DataFrame]
    checks: DataFrame
    summary: DataFrame
    datasets: dict[str, DataFrame]
    version: Version | None = None
    complete: DataFrame | None = None  # the checks of completeness, beside the 66


class ExportMismatch(RuntimeError):
    """An export read back differs from its dataset."""


def gathered(trips: DataFrame, spec: TripSpec) -> DataFrame:
    """The period's trips, raw columns only, brought together by pickup date.

    This is the one shuffle of whole trips in a refresh. It comes before anything is derived, so durations and label
    strings don't travel. The rebalance step sizes its tasks by bytes: a date that holds a large share of the trips is
    split, small dates are merged.
    """
    dated = trips.where(in_period(spec)).withColumn("pickup_date", F.to_date(spec.pickup_ts))
    return dated.hint("rebalance", "pickup_date").drop("pickup_date")


def write_trips(trips: DataFrame, lookup: DataFrame, spec: TripSpec, folder: str) -> int:
    """Write the period's trips, staged and labelled, to a new folder, a partition per date and verdict; the number of
    raw trips that were read for it."""
    read = Observation()
    counted = trips.where(in_period(spec)).observe(read, F.count(F.lit(1)).alias("rows"))
    labelled = label_trips(clean_trips(gathered(counted, spec), spec), lookup, spec)
    date = F.col("pickup_date").cast("string")
    parts = labelled.withColumn(PART, F.when(F.col(VALID), date).otherwise(F.concat(F.lit(REJECTED), date)))
    parts.write.mode("errorifexists").partitionBy(PART).parquet(folder)
    return read.get["rows"]


def trips_schema(trips: DataFrame, lookup: DataFrame, spec: TripSpec):
    return label_trips(clean_trips(trips, spec), lookup, spec).schema


def _dates(spec: TripSpec) -> tuple[str, str]:
    return str(spec.period_start.date()), str((spec.period_end - timedelta(microseconds=1)).date())


def _of_period(spec: TripSpec, key: str) -> bool:
    first, last = _dates(spec)
    return first <= key.removeprefix(REJECTED) <= last


def read_enriched(spark: SparkSession, out: str, spec: TripSpec, version: Version | None = None) -> DataFrame:
    """Eligible trips of one period as published, in the latest version or the one given; no other date is listed or
    read. The frame stays bound to that version."""
    version = version or manifest.current(spark, out)
    rows = manifest.read_partitions(spark, out, version, lambda key: not key.startswith(REJECTED) and _of_period(spec, key))
    return rows.where(in_period(spec))


def read_staged(spark: SparkSession, out: str, spec: TripSpec, version: Version | None = None) -> DataFrame:
    """Eligible and rejected trips of one period as published, with their flags."""
    rows = manifest.read_partitions(spark, out, version or manifest.current(spark, out), lambda key: _of_period(spec, key))
    return rows.where(in_period(spec))


def build(trips: DataFrame, lookup: DataFrame, spec: TripSpec, out: str, folder: str) -> tuple[Refresh, Version]:
    """Everything up to, but not including, the exports, in a folder of this run; also the version that publishing it
    would make of an empty table. Raises if any check fails."""
    spark = trips.sparkSession
    counted = write_trips(trips, lookup, spec, folder)
    schema = trips_schema(trips, lookup, spec)
    draft = Version(0, schema.json(), manifest.written_partitions(spark, out, folder))
    staged, enriched = read_staged(spark, out, spec, draft), read_enriched(spark, out, spec, draft)
    # A task that ran twice may have counted its trips twice, never too few. Unless the stored rows confirm the count, it
    # is taken anew.
    raw_rows = counted if counted == staged.count() else None

    # Reports come from these totals; the checks aggregate the enriched table again.
    place_hours = durable(trip_totals(enriched, spec, *PLACE_HOUR), "report-place-hours")
    routes = durable(trip_totals(enriched, spec, *ROUTE), "report-routes")
    marts = all_marts(place_hours, routes, spec)

    evidence = stored_evidence(spec, trips, staged, lookup, enriched, marts, raw_rows)
    checks = durable(all_checks(evidence), "checks")
    complete = durable(checks_completeness(evidence), "completeness")
    enforce(checks.unionByName(complete))

    summary = published.summary(place_hours, marts["zone_performance"], staged, spec)
    datasets = {name: marts[name] for name in published.ORDER if name in marts}
    datasets["priority_table"] = published.priority_table(marts["priority_windows"])
    datasets["airport_table"] = published.airport_table(marts["airport_comparison"], spec)
    return Refresh(enriched, marts, checks, summary, datasets, complete=complete), draft


def stored_evidence(
    spec: TripSpec,
    trips: DataFrame,
    staged: DataFrame,
    lookup: DataFrame,
    enriched: DataFrame,
    marts: dict[str, DataFrame],
    raw_rows: int | None = None,
) -> Evidence:
    """Evidence whose expected totals are one stored aggregate for places and hours and one for routes.

    Both are aggregated here, from the enriched table, apart from the totals behind the reports. `raw_rows` is the
    number of the period's raw trips where it is known; else they are counted.
    """
    stored: dict[bool, DataFrame] = {}

    def totals(grain: tuple[str, ...]) -> DataFrame:
        by_route = grain == ROUTE
        if by_route not in stored:
            keys = ROUTE if by_route else PLACE_HOUR
            stored[by_route] = durable(expected_totals(enriched, spec, *keys), "evidence")
        return stored[by_route]

    return Evidence(spec, trips, staged, lookup, enriched, marts, totals, raw_rows=raw_rows)


def about(summary: DataFrame, spec: TripSpec) -> DataFrame:
    first, last = _dates(spec)
    text: tuple[Column, ...] = (F.lit(spec.source).alias("source"), F.lit(f"{first} through {last}").alias("reporting_period"))
    return summary.select(*text)


def export(result: Refresh, spec: TripSpec, folder: str) -> dict[str, str]:
    """Write every published dataset below `folder` and read it back: Parquet in its published order, CSV, and the
    evidence as JSON lines. Raises unless rows, values and order are those of the dataset. Names and paths."""
    spark = result.summary.sparkSession
    paths, verified = {}, []
    for name, dataset in result.datasets.items():
        paths[f"extract/{name}"], paths[f"csv/{name}"] = f"{folder}/extract/{name}", f"{folder}/csv/{name}"
        verified.append(verified_extract(dataset, paths[f"extract/{name}"], published.ORDER[name]))
        stored = spark.read.schema(dataset.schema).parquet(paths[f"extract/{name}"])
        write_csv(published.ordered(stored, name), paths[f"csv/{name}"])
        verified.append(contract_violations(spark, paths[f"csv/{name}"], dataset.schema))
    evidence = {"about": about(result.summary, spec), "summary": result.summary, "quality_checks": result.checks}
    if result.complete is not None:
        evidence["completeness_checks"] = result.complete
    evidence.update({name: result.marts[name] for name in published.ORDER if name in result.marts})
    verified.append(verified_evidence(evidence, f"{folder}/evidence"))
    paths.update({f"evidence/{name}": f"{folder}/evidence/{name}" for name in evidence})
    for row in (row for frame in verified for row in frame.collect()):  # a row per dataset and form
        if "FAIL" in row:
            raise ExportMismatch(f"export does not match its dataset: {row}")
    return paths


def run_refresh(trips: DataFrame, lookup: DataFrame, spec: TripSpec, out: str) -> Refresh:
    """Build, check, export and publish a new version below `out`.

    It holds the enriched trips by date (dates of the period are replaced, and disappear if they have no trips any
    more), the rejected ones, and the datasets as `extract/`, `csv/` and `evidence/`. Nothing is published unless every
    check passes and every export reads back right; then all of it is, at once.
    """
    spark = trips.sparkSession
    before = manifest.current(spark, out)
    folder, exports = manifest.fresh_folder(out), manifest.fresh_folder(out)
    try:
        result, draft = build(trips, lookup, spec, out, folder)
        paths = export(result, spec, exports)
        datasets = {name: path.removeprefix(f"{out}/") for name, path in paths.items()}
        schema = trips_schema(trips, lookup, spec)
        version = manifest.publish(spark, out, schema, draft.partitions, lambda key: _of_period(spec, key), datasets, before)
    except BaseException:
        for path in (folder, exports):
            manifest.drop(spark, path)
        raise
    enriched = read_enriched(spark, out, spec, version)
    return Refresh(enriched, result.marts, result.checks, result.summary, result.datasets, version, result.complete)


def published_dataset(spark: SparkSession, out: str, name: str, version: Version | None = None) -> str:
    """Where a published dataset lies, as `csv/hourly_demand`, in the latest version or the one given."""
    version = version or manifest.current(spark, out)
    if version is None or name not in version.datasets:
        raise FileNotFoundError(f"{name} is not published below {out}")
    return f"{out}/{version.datasets[name]}"
