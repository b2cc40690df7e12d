import json
import os
import subprocess
import sys
from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import WEEK, trip
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrain.operators.checks import ChecksFailed
from tripgrain.operators.enrich import enrich
from tripgrain.operators.fingerprint import fingerprint
from tripgrain.operators.positions import read_in_order
from tripgrain.operators.rank import top
from tripgrain.operators.staging import clean_trips
from tripgrain.operators.totals import trip_totals
from tripgrain.plans import insights, published
from tripgrain.plans.marts import REPORTS, mart
from tripgrain.plans.suites import SUITES
from tripgrain.plans.refresh import published_dataset, read_enriched, read_staged, run_refresh, trips_schema, write_trips
from tripgrain.session import drop_copies, durable, run_dir, shared_dir
from tripgrain.sinks import contract_violations, manifest, read_csv_back, verified_evidence, verified_extract, write_csv, write_evidence
from tripgrain.sinks.datasets import compare_evidence, compare_extract
from tripgrain.spec import TripSpec
from tripgrain.views import register_published, register_views


# --- formatted tables: published rows and the figures behind them ---------------------------------------


def test_priority_table_text(spark):
    rows = [
        (1, "Upper East Side South", 15, 393.29, 4.34),
        (2, "Upper East Side North", 15, 412.48, 4.14),
        (3, "JFK Airport", 20, 1360.94, 4.03),
        (4, "Midtown Center", 8, 0.25, 3.0),
    ]
    windows = spark.createDataFrame(
        rows,
        "zone_rank bigint, pickup_zone string, peak_hour int, avg_peak_hour_trips_per_calendar_day double, monthly_trip_share_pct double",
    )
    assert [tuple(r) for r in published.priority_table(windows).collect()] == [
        ("1. Upper East Side South", "15:00", "393.3", "4.34%", ""),
        ("2. Upper East Side North", "15:00", "412.5", "4.14%", ""),
        ("3. JFK Airport", "20:00", "1,360.9", "4.03%", ""),
        ("4. Midtown Center", "08:00", "0.2", "3.00%", ""),
    ]


def test_airport_table_text(spark):
    rows = [("JFK Airport", 141612, 79.27, 38.6), ("Other pickup zones", 3294775, 1026.5, 16.25)]
    segments = spark.createDataFrame(
        rows, "pickup_segment string, total_trips bigint, avg_recorded_payment_usd double, avg_trip_minutes double"
    )
    table = published.airport_table(segments, TripSpec())
    assert table.columns == ["Pickup_area", "January_trips", "Payment_per_trip_USD", "Minutes_per_trip", "Label"]
    assert [tuple(r) for r in table.collect()] == [
        ("JFK Airport", "141,612", "$79.27", "38.6", ""),
        ("Other pickup zones", "3,294,775", "$1,026.50", "16.2", ""),
    ]


def test_leading_zone_share_of_published_counts(spark):
    """Published totals: the 15 leading zones hold 1,611,413 of 3,517,775 trips, which is 45.8 %."""
    counts = [(f"z{i:02d}", "b", n) for i, n in enumerate([107427] * 14 + [107435])] + [("rest", "b", 3_517_775 - 1_611_413)]
    zones = spark.createDataFrame(counts, "pickup_zone string, pickup_borough string, total_trip_count bigint").where("pickup_zone <> 'rest'")
    best = top(zones, 15, F.desc("total_trip_count")).agg(F.sum("total_trip_count")).first()[0]
    assert best == 1_611_413 and round(100.0 * best / 3_517_775, 1) == 45.8


# --- datasets over the week -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def week(trips_of, places, week_rows):
    staged = clean_trips(trips_of(week_rows), WEEK).cache()
    return staged, enrich(staged, places, WEEK).cache()


def test_summary(week):
    staged, enriched = week
    totals = trip_totals(enriched, WEEK, "pickup_zone", "pickup_borough")
    got = published.summary(totals, mart("zone_performance", enriched, WEEK), staged, WEEK).first()
    rows = enriched.collect()
    assert got.eligible_trips == len(rows) == 84
    assert got.week_source_trips == 86
    assert got.missing_passenger_count == sum(r.passenger_count is None for r in rows)
    assert got.avg_payment == pytest.approx(sum(r.total_amount for r in rows) / 84)
    assert got.top15_share_pct == 100.0


def test_heatmap_and_bars(week):
    _, enriched = week
    hours = mart("zone_hourly_performance", enriched, WEEK)
    grid = {r.pickup_zone: r for r in published.zone_hour_heatmap(hours, WEEK).collect()}
    assert set(grid) == {"East Village", "JFK Airport", "Midtown Center"}
    for r in hours.where("pickup_zone = 'Midtown Center'").collect():
        assert grid["Midtown Center"][f"h{r.pickup_hour_of_the_day:02d}"] == r.avg_trips_per_active_day
    bars = published.top_zones(mart("zone_performance", enriched, WEEK), WEEK).collect()
    assert [b.total_trip_count for b in bars] == sorted((b.total_trip_count for b in bars), reverse=True)
    assert published.daily_line(mart("daily_demand_revenue", enriched, WEEK)).count() == 7
    assert published.hour_bars(mart("hourly_demand", enriched, WEEK)).count() == mart("hourly_demand", enriched, WEEK).count()


def test_week_over_week_uses_the_calendar(spark):
    days = [(date(2026, 1, 18), 115420), (date(2026, 1, 25), 43552), (date(2026, 1, 27), 10)]
    daily = spark.createDataFrame(days, "pickup_date date, daily_trip_count bigint")
    assert [tuple(r) for r in insights.week_over_week(daily).collect()] == [(date(2026, 1, 25), 43552, 115420, -62.27)]


def test_findings(week):
    staged, enriched = week
    shares = insights.borough_share(mart("zone_performance", enriched, WEEK)).collect()
    assert sum(r.trips for r in shares) == 84 and abs(sum(r.share_pct for r in shares) - 100) < 0.05
    rejected = {str(r.pickup_date): r for r in insights.daily_rejections(staged, WEEK).collect()}
    assert (rejected["2026-01-06"].source_trips, rejected["2026-01-06"].eligible_trips) == (14, 12)
    assert {r.hours_observed for r in insights.hours_per_date(enriched, WEEK).collect()} == {12}
    hours = mart("zone_hourly_performance", enriched, WEEK)
    leaders = insights.hour_leaders(hours).collect()
    assert len(leaders) == hours.select("pickup_hour_of_the_day").distinct().count()
    assert insights.zone_peak_active(hours, WEEK).count() == 3
    extremes = insights.hour_extremes(mart("hourly_demand", enriched, WEEK)).first()
    assert extremes.busiest_avg_trips >= extremes.quietest_avg_trips
    info = insights.coverage_info(enriched, WEEK).first()
    assert info.eligible_trips == 84 and info.missing_passenger_count == 28


# --- sinks ----------------------------------------------------------------------------------------------


def test_csv_round_trip_keeps_values_nulls_and_order(spark, week, tmp_path):
    report = published.ordered(mart("zone_performance", week[1], WEEK), "zone_performance")
    path = write_csv(report, str(tmp_path / "zones"))
    back = read_csv_back(spark, path, report.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, report.collect()))
    counts = [r.total_trip_count for r in report.collect()]
    assert counts == sorted(counts, reverse=True)


@pytest.fixture
def exported(tmp_path):
    def write(text):
        folder = tmp_path / f"csv-{len(os.listdir(tmp_path))}"
        folder.mkdir()
        (folder / "part-0.csv").write_text(text)
        return str(folder)

    return write


FIELDS = T.StructType([T.StructField("zone", T.StringType()), T.StructField("trips", T.LongType())])


@pytest.mark.parametrize(
    "text, rows, broken",
    [
        ("zone,trips\na,1\nb,2\n", 2, 0),
        ("zone,trips\na,1,9\nb,2\n", 2, 1),
        ("zone,trips\na\nb,2\n", 2, 1),
        ("zone,trips\na,many\nb,2\n", 2, 1),
        ('zone,trips\n"a, b",1\n"",\n', 2, 0),
    ],
)
def test_export_contract(spark, exported, text, rows, broken):
    got = contract_violations(spark, exported(text), FIELDS).first()
    assert (got.rows_read, got.rows_broken, got.contract_status) == (rows, broken, "FAIL" if broken else "PASS")


def test_export_contract_compares_the_header(spark, exported):
    with pytest.raises(Exception, match="(?i)header"):
        contract_violations(spark, exported("area,trips\na,1\n"), FIELDS).collect()


def test_verified_extract(spark, week, tmp_path):
    got = verified_extract(mart("hourly_demand", week[1], WEEK), str(tmp_path / "hours")).first()
    assert got.rows_stored == got.rows_expected > 0 and got.extract_status == "PASS"


def change(folder, old, new):
    """Replace text in the files of a folder; how many files held it."""
    changed = 0
    for name in os.listdir(folder):
        if name.startswith("part-"):
            text = open(f"{folder}/{name}").read()
            changed += old in text
            open(f"{folder}/{name}", "w").write(text.replace(old, new))
            if os.path.exists(f"{folder}/.{name}.crc"):
                os.remove(f"{folder}/.{name}.crc")
    return changed


def test_one_altered_digit_fails(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.25, None), ("b", 2.5, 7), ("b", 2.5, 7)], "zone string, amount double, trips int")
    path = str(tmp_path / "evidence")
    status = lambda frame: [r[-1] for r in frame.collect()]
    assert status(verified_evidence({"zones": df}, path)) == ["PASS"]
    expected = fingerprint(df).first().asDict()
    assert status(compare_evidence(spark, "zones", df.schema, expected, f"{path}/zones")) == ["PASS"]
    assert change(f"{path}/zones", "1.25", "1.26") == 1
    assert status(compare_evidence(spark, "zones", df.schema, expected, f"{path}/zones")) == ["FAIL"]
    extract = str(tmp_path / "extract")
    assert status(verified_extract(df, extract, ["zone"])) == ["PASS"]
    for wrong in (df.replace(2.5, 2.4), df.distinct(), df.withColumn("trips", F.coalesce("trips", F.lit(0)))):
        wrong.coalesce(1).write.mode("overwrite").parquet(extract)
        assert status(compare_extract(spark, df.schema, expected, extract)) == ["FAIL"]


def test_fingerprints_tell_bags_of_rows_apart(spark):
    shape = "a int, b int"
    of = lambda *rows: tuple(fingerprint(spark.createDataFrame(rows, shape).repartition(3)).first())
    assert of((1, 2), (3, None), (1, 2)) == of((3, None), (1, 2), (1, 2))
    others = [of((1, 2)), of((2, 1)), of((None, 1)), of((1, None)), of((1, 2), (1, 2)), of((1, 2), (1, 2), (1, 2)), of((None, None)), of((0, 0))]
    assert len(set(others)) == len(others) and tuple(fingerprint(spark.createDataFrame([], shape)).first()) == (0, 0, 0)


def test_a_shuffled_export_fails(spark, week, tmp_path):
    report, order = mart("zone_hourly_performance", week[1], WEEK), published.ORDER["zone_hourly_performance"]
    path = str(tmp_path / "ordered")
    assert verified_extract(report, path, order).first().extract_status == "PASS"
    expected = fingerprint(report).first().asDict()
    report.repartition(3, "pickup_hour_of_the_day").write.mode("overwrite").parquet(path)
    assert compare_extract(spark, report.schema, expected, path).first().extract_status == "PASS"  # as a bag of rows
    assert compare_extract(spark, report.schema, expected, path, order).first().extract_status == "FAIL"


def test_order_puts_nulls_last_either_way(spark, tmp_path):
    df = spark.createDataFrame([(2, "a"), (2, None), (None, "a"), (None, None), (1, "b")], "n int, z string")
    for order in (["-n", "z"], ["n", "-z"]):
        path = str(tmp_path / order[0])
        assert verified_extract(df, path, order).first().extract_status == "PASS"
        rows = [tuple(r)[:2] for r in sorted(read_in_order(spark, path, df.schema).collect(), key=lambda r: r.position)]
        down = order[0].startswith("-")
        assert rows == ([(2, "a"), (2, None), (1, "b"), (None, "a"), (None, None)] if down else [(1, "b"), (2, "a"), (2, None), (None, "a"), (None, None)])


def test_evidence_documents_keep_null_fields(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 2)], "zone string, trips int")
    path = write_evidence({"zones": df}, str(tmp_path / "evidence"))["zones"]
    lines = [json.loads(line[0]) for line in spark.read.text(path).collect()]
    assert sorted(lines, key=lambda x: x["zone"]) == [{"zone": "a", "trips": None}, {"zone": "b", "trips": 2}]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")
    assert durable(spark.range(5), "five").count() == 5


class Unnamed:
    """A session whose shared folder is not set."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        applicationId = "app-1"
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Unnamed)
    monkeypatch.setattr(Unnamed.sparkContext, "master", "local[2]")
    assert shared_dir(Unnamed) == "spark-warehouse/_checkpoints"


# --- views and refresh ----------------------------------------------------------------------------------


def test_all_views_answer_sql(spark, trips_of, places, week_rows):
    names = register_views(trips_of(week_rows), places, WEEK)
    assert names == ["stg_yellow_trips", "enriched_yellow_trips", *REPORTS] and len(names) == 11
    ranked = spark.sql("SELECT * FROM priority_windows ORDER BY zone_rank").collect()
    assert [r.zone_rank for r in ranked] == [1, 2]
    total = spark.sql("SELECT sum(total_trip_count) FROM zone_performance").first()[0]
    assert total == spark.sql("SELECT count(*) FROM enriched_yellow_trips").first()[0]
    for name in names:
        assert spark.table(name).count() > 0
        spark.catalog.dropTempView(name)


def lines(df):
    return sorted(map(str, df.collect()))


def test_refresh_publishes_everything_it_checked(spark, trips_of, places, week_rows, tmp_path):
    out = str(tmp_path / "out")
    result = run_refresh(trips_of(week_rows), places, WEEK, out)
    assert result.checks.count() == 66 and result.checks.where("check_status = 'PASS'").count() == 66
    forms = {f: {n.split("/")[1] for n in result.version.datasets if n.startswith(f)} for f in ("csv", "extract", "evidence")}
    assert forms["csv"] == forms["extract"] == set(published.ORDER)
    assert {"summary", "quality_checks", "priority_windows"} <= forms["evidence"]
    at = lambda name: published_dataset(spark, out, name)
    assert tuple(spark.read.json(at("evidence/about")).select("source", "reporting_period").first()) == ("trip records", "2026-01-05 through 2026-01-11")
    assert lines(spark.read.parquet(at("extract/priority_windows"))) == lines(result.marts["priority_windows"])
    assert len([key for key in result.version.partitions if key.startswith("2026-")]) == 7
    assert [key for key in result.version.partitions if not key.startswith("2026-")] == ["rejected-2026-01-06"]
    assert spark.read.json(at("evidence/quality_checks")).count() == 66
    # rejected trips are kept beside the eligible ones
    staged = read_staged(spark, out, WEEK)
    assert (staged.count(), read_enriched(spark, out, WEEK).count()) == (86, 84)
    assert lines(staged.select(*clean_trips(trips_of(week_rows), WEEK).columns)) == lines(clean_trips(trips_of(week_rows), WEEK))
    assert lines(result.enriched) == lines(enrich(clean_trips(trips_of(week_rows), WEEK), places, WEEK))


def test_refresh_stops_before_publishing_when_a_check_fails(spark, trips_of, places, week_rows, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(ChecksFailed, match="null pickup zone"):
        run_refresh(trips_of([*week_rows, trip(origin=99)]), places, WEEK, out)
    assert manifest.current(spark, out) is None and os.listdir(f"{out}/data") == []


def put(spark, trips, places, spec, out, replaced=None):
    """Publish trips without reports and checks."""
    folder, before = manifest.fresh_folder(out), manifest.current(spark, out)
    write_trips(trips, places, spec, folder)
    parts, schema = manifest.written_partitions(spark, out, folder), trips_schema(trips, places, spec)
    return manifest.publish(spark, out, schema, parts, replaced or (lambda key: True), {}, before)


def test_a_refresh_killed_at_any_step_leaves_the_former_version(spark, trips_of, places, week_rows, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    whole = run_refresh(trips_of(week_rows), places, WEEK, out)
    before = lines(read_enriched(spark, out, WEEK)), open_text(published_dataset(spark, out, "csv/hourly_demand"))
    assert whole.version.number == 1

    def killed(*args, **named):
        raise KeyboardInterrupt

    def after_a_kill(step):
        with monkeypatch.context() as patch:
            patch.setattr(f"tripgrain.plans.refresh.{step}", killed)
            with pytest.raises(KeyboardInterrupt):
                run_refresh(trips_of(week_rows[:20]), places, WEEK, out)
        assert manifest.current(spark, out) == whole.version
        assert (lines(read_enriched(spark, out, WEEK)), open_text(published_dataset(spark, out, "csv/hourly_demand"))) == before

    for step in ("write_trips", "trip_totals", "all_marts"):
        after_a_kill(step)
    # the steps after the checks, with what one build has made and a single dataset
    one = {"priority_windows": whole.datasets["priority_windows"]}
    short = replace(whole, datasets=one, marts=one)
    monkeypatch.setattr("tripgrain.plans.refresh.build", lambda *args: (short, whole.version))
    for step in ("export", "verified_extract", "write_csv", "contract_violations", "verified_evidence", "manifest.publish"):
        after_a_kill(step)
    assert manifest.drop_unused(spark, out) == []


def open_text(folder):
    return "".join(open(f"{folder}/{n}").read() for n in sorted(os.listdir(folder)) if n.endswith(".csv"))


def test_an_unfinished_manifest_is_no_version(spark, tmp_path):
    out, schema = str(tmp_path), T.StructType([T.StructField("x", T.LongType())])
    one = manifest.publish(spark, out, schema, {"a": "data/1/part=a"}, lambda key: True, {"csv/x": "data/2/csv/x"}, None)
    with open(f"{out}/manifests/00000002.json", "w") as half:
        half.write('{"schema": "')
    assert manifest.current(spark, out) == one == manifest.current(spark, out, 1) and manifest.current(spark, out, 2) is None
    two = manifest.publish(spark, out, schema, {"b": "data/3/part=b"}, lambda key: key == "b", {}, one)
    assert two.number == 3 and two.partitions == {"a": "data/1/part=a", "b": "data/3/part=b"}
    with pytest.raises(manifest.Superseded):  # another run has published since version 1
        manifest.publish(spark, out, schema, {}, lambda key: True, {}, one)
    assert manifest.current(spark, out) == two


def test_two_runs_can_not_take_one_number(spark, tmp_path, monkeypatch):
    out, schema = str(tmp_path), T.StructType([T.StructField("x", T.LongType())])
    manifest.publish(spark, out, schema, {}, lambda key: True, {}, None)
    monkeypatch.setattr(manifest, "_numbers", lambda *args: [])  # as seen before the other run had published
    with pytest.raises(manifest.Superseded):
        manifest.publish(spark, out, schema, {}, lambda key: True, {}, None)


def test_views_stay_with_one_version(spark, trips_of, places, week_rows, tmp_path):
    out = str(tmp_path / "out")
    put(spark, trips_of(week_rows), places, WEEK, out)
    names = register_published(spark, out, WEEK)
    assert len(names) == 11
    totals = "SELECT (SELECT sum(total_trip_count) FROM zone_performance), (SELECT count(*) FROM enriched_yellow_trips), (SELECT count(*) FROM stg_yellow_trips)"
    assert tuple(spark.sql(totals).first()) == (84, 84, 86)
    put(spark, trips_of(week_rows + [trip("2026-01-07 03:00:00", "2026-01-07 03:30:00")]), places, WEEK, out)
    assert tuple(spark.sql(totals).first()) == (84, 84, 86)
    register_published(spark, out, WEEK)
    assert tuple(spark.sql(totals).first()) == (85, 85, 87)
    for name in names:
        spark.catalog.dropTempView(name)


@pytest.mark.parametrize("twice", [0, 5])
def test_a_count_that_stored_rows_deny_is_taken_anew(trips_of, places, week_rows, tmp_path, monkeypatch, twice):
    from tripgrain.plans import refresh

    class Seen(Exception):
        pass

    def look(evidence):
        raise Seen(evidence.raw_rows, SUITES["checks_staging"](evidence).where("check_status = 'FAIL'").count())

    honest = refresh.write_trips
    monkeypatch.setattr(refresh, "write_trips", lambda *args: honest(*args) + twice)  # as after a lost executor
    monkeypatch.setattr(refresh, "all_marts", lambda *args: {})
    monkeypatch.setattr(refresh, "durable", lambda df, label: df)
    monkeypatch.setattr(refresh, "all_checks", look)
    with pytest.raises(Seen) as seen:
        refresh.build(trips_of(week_rows), places, WEEK, str(tmp_path), manifest.fresh_folder(str(tmp_path)))
    assert seen.value.args == (None if twice else 86, 0)


ONE_SCAN = """
import sys
from conftest import WEEK
from tripgrain.plans.refresh import run_refresh
from tripgrain.session import build_session
raw, places, out, events = sys.argv[1:]
spark = build_session("scans", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": f"{out}/shared", "spark.sql.warehouse.dir": f"{out}/warehouse"})
run_refresh(spark.read.parquet(raw), spark.read.parquet(places), WEEK, f"{out}/published")
spark.stop()
"""


def test_a_refresh_reads_raw_trips_once(trips_of, places, week_rows, tmp_path):
    raw, lookup, events = (str(tmp_path / n) for n in ("raw", "places", "events"))
    trips_of(week_rows).coalesce(1).write.parquet(raw)
    places.write.parquet(lookup)
    os.mkdir(events)
    here = os.path.dirname(os.path.abspath(__file__))
    env = dict(os.environ, PYTHONPATH=os.pathsep.join([here, os.path.dirname(here)]))
    subprocess.run([sys.executable, "-c", ONE_SCAN, raw, lookup, str(tmp_path / "run"), events], check=True, env=env, timeout=600, capture_output=True)
    (log,) = os.listdir(events)
    scans = []

    def walk(node):
        if "Scan" in node["nodeName"] and any(raw in str(v) for v in [node["simpleString"], *node.get("metadata", {}).values()]):
            scans.append(node["simpleString"])
        for child in node["children"]:
            walk(child)

    for event in map(json.loads, open(f"{events}/{log}")):
        if event["Event"].endswith("SparkListenerSQLExecutionStart"):
            walk(event["sparkPlanInfo"])
    assert len(scans) == 1, scans


def test_copies_are_removed(spark, trips_of):
    durable(trips_of([trip()]), "x")
    mine = f"{shared_dir(spark)}/tripgrain/{spark.sparkContext.applicationId}"
    assert os.listdir(mine)
    drop_copies(spark)
    assert not os.path.exists(mine)


def test_enriched_table_is_replaced_per_date(spark, trips_of, places, tmp_path):
    out = str(tmp_path / "out")
    wide = TripSpec(period_start=datetime(2026, 1, 5), period_end=datetime(2026, 1, 19))

    def put_rows(rows, spec):
        first, end = str(spec.period_start.date()), str(spec.period_end.date())
        return put(spark, trips_of(rows), places, spec, out, lambda key: first <= key < end)

    one = put_rows([trip(), trip("2026-01-13 10:00:00", "2026-01-13 10:30:00")], wide)
    two = put_rows([trip(), trip(), trip()], WEEK)
    assert read_enriched(spark, out, wide).count() == 4
    assert read_enriched(spark, out, WEEK).count() == 3
    assert read_enriched(spark, out, wide, one).count() == 2
    # a date that has lost its last trip is not kept
    put_rows([trip("2026-01-06 10:00:00", "2026-01-06 10:30:00")], WEEK)
    assert read_enriched(spark, out, WEEK).count() == 1
    # versions before the last two lose what only they hold
    folders = {v.split("/")[1] for v in one.partitions.values()} - {v.split("/")[1] for v in two.partitions.values()}
    assert folders == set() and manifest.drop_unused(spark, out, keep=1) == sorted({two.partitions["2026-01-05"].split("/")[1]})
    assert read_enriched(spark, out, wide).count() == 2
