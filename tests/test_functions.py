import random
from datetime import datetime, timedelta
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrain.functions import logic
from tripgrain.functions.numeric import add_parts, exact_parts, exact_sum, mean, mean_of_parts, percent, ratio, round_to, sum_of_parts, with_values
from tripgrain.functions.temporal import micros_between, seconds_between, to_minutes, with_interval_text

PAIR = T.StructType([T.StructField("a", T.TimestampNTZType()), T.StructField("b", T.TimestampNTZType())])


def elapsed(spark, pairs):
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame(pairs, PAIR).withColumns({"s": seconds_between(a, b), "us": micros_between(a, b)})
    return with_interval_text(df.withColumn("m", to_minutes("s")), "a", "b", "text").collect()


def test_rounding_takes_the_stored_value(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (2.675,), (2.5,), (-2.5,), (None,)], "x double")
    assert [r[0] for r in df.select(round_to(F.col("x"), 2)).collect()] == [1.0, 0.28, 2.68, 2.5, -2.5, None]
    assert [r[0] for r in df.select(round_to(F.col("x"))).collect()] == [1.0, 0.0, 3.0, 3.0, -3.0, None]


@pytest.mark.parametrize(
    "delta, text",
    [
        (timedelta(0), "00:00:00"),
        (timedelta(minutes=15), "00:15:00"),
        (timedelta(minutes=-9, seconds=-55), "-00:09:55"),
        (timedelta(days=-1, hours=-2), "-1 day -02:00:00"),
        (timedelta(days=1), "1 day"),
        (timedelta(days=2, seconds=1), "2 days 00:00:01"),
        (timedelta(days=60, hours=1), "60 days 01:00:00"),
        (timedelta(milliseconds=-250), "-00:00:00.25"),
        (timedelta(days=3, microseconds=10), "3 days 00:00:00.00001"),
    ],
)
def test_interval_text(spark, delta, text):
    start = datetime(2026, 1, 5, 6, 7, 8)
    assert elapsed(spark, [(start, start + delta)])[0].text == text


def test_seconds_count_boundaries(spark):
    day = "2026-01-05 00:00:0"
    rows = elapsed(
        spark,
        [
            (datetime.fromisoformat(day + "0.900000"), datetime.fromisoformat(day + "1.100000")),
            (datetime.fromisoformat(day + "1.100000"), datetime.fromisoformat(day + "0.900000")),
            (datetime(1969, 12, 31, 23, 59, 59, 900000), datetime(1970, 1, 1)),
            (None, datetime(2026, 1, 1)),
        ],
    )
    assert [r.s for r in rows] == [1, -1, 1, None]
    assert [r.us for r in rows] == [200_000, -200_000, 100_000, None]
    assert rows[3].text is None and rows[3].m is None


def test_minutes_equal_rounded_division(spark):
    start = datetime(2026, 1, 5)
    seconds = [*range(-200, 200), 3599, 86_399, 10**6 + 1]
    rows = elapsed(spark, [(start, start + timedelta(seconds=s)) for s in seconds])
    for s, row in zip(seconds, rows):
        scaled = s / 60.0 * 100.0
        assert row.m == (1 if s >= 0 else -1) * int(abs(scaled) + 0.5) / 100.0


def test_durations_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # clocks are set forward between these two moments in that zone
        row = elapsed(spark, [(datetime(2026, 3, 8, 1, 30), datetime(2026, 3, 8, 3, 30))])[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row.s, row.text) == (7200, "02:00:00")


def nearest(values):
    """The double nearest to the sum of the values as they are stored."""
    known = [Fraction(v) for v in values if v is not None]
    return float(sum(known)) if known else None


def summed(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact_sum(df, "x")).first()[0]


def test_exact_sum_ignores_order_and_partitions(spark):
    values = [round(random.Random(7).uniform(-50, 500), 2) for _ in range(3000)] + [0.1] * 10
    for parts in (1, 7):
        assert summed(spark, list(reversed(values)), parts) == nearest(values)


@pytest.mark.parametrize(
    "values",
    [
        [3e-19] * 10, [1.8e20], [9e19, 9e19], [1e22, 3e-19, -1e22], [0.1, 0.2], [2.0**53, 1.0], [2.0**53, 3.0], [2.0**53, 1.0, 2.0**-60],
        [-(2.0**53), -1.0, -(2.0**-100)], [2.0**53, 1.0, -(2.0**-100)], [1e16, 1.0, -1e16], [-1e16, -1.0, 1e16], [-3e-19] * 7, [1e23] * 9,
        [5e-20 * k for k in range(-3, 9) if abs(k) > 6], [None, None], [None, 0.0, -0.0], [0.0000004] * 10, [],
    ],
)
def test_exact_sum_is_the_nearest_double(spark, values):
    assert summed(spark, values) == nearest(values)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e22, 1e22).filter(lambda v: v == 0 or abs(v) > 1e-18)), max_size=40))
def test_exact_sum_of_any_doubles(spark, values):
    assert summed(spark, values) == nearest(values)


def test_exact_sum_of_nulls_and_decimals(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (2, 1e12, 3), (2, -0.000001, 4)], "k int, x double, n int")
    got = {r.k: (r.x, r.n) for r in df.groupBy("k").agg(exact_sum(df, "x").alias("x"), exact_sum(df, "n").alias("n")).collect()}
    assert got == {1: (None, None), 2: (nearest([1e12, -0.000001]), 7)}
    money = df.select(F.col("x").cast("decimal(24,6)").alias("x"))
    assert money.agg(exact_sum(money, "x")).first()[0] == Decimal("999999999999.999999")


def test_exact_sum_refuses_what_it_can_not_keep(spark):
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for setting in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", setting)
            for value in (float("nan"), float("inf"), float("-inf"), 3e23, -3e23, 1e-30):
                for form in (exact_sum, exact_parts):
                    df = spark.createDataFrame([(1.0,), (value,)], "x double")
                    with pytest.raises(Exception, match="can't be summed"):
                        df.agg(form(df, "x")).collect()
            assert summed(spark, [9e19, 9e19, 0.5]) == 1.8e20
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_parts_add_up_at_any_grain(spark):
    dice = random.Random(11)
    rows = [(dice.randrange(5), dice.randrange(7), dice.uniform(-1, 1) * 10 ** dice.randint(-6, 9) if dice.random() < 0.8 else None) for _ in range(800)]
    rows += [(9, 0, None), (9, 1, None)]
    df = spark.createDataFrame(rows, "a int, b int, odd`name double".replace("odd`name", "x")).repartition(5)
    fine = df.groupBy("a", "b").agg(exact_parts(df, "x").alias("x"))
    shown = {(r.a, r.b): r.x for r in with_values(fine).collect()}
    assert shown == {k: nearest([v for a, b, v in rows if (a, b) == k]) for k in shown}
    coarse = fine.groupBy("a").agg(add_parts(fine, "x").alias("x"))
    by_a = {r.a: r.x for r in with_values(coarse).collect()}
    assert by_a == {k: nearest([v for a, _, v in rows if a == k]) for k in by_a} and by_a[9] is None
    row = coarse.agg(sum_of_parts(coarse, "x"), mean_of_parts(coarse, "x")).first()
    assert row[0] == nearest([v for *_, v in rows]) and row[1] == row[0] / 5


def test_exact_sum_of_an_odd_column_name(spark):
    df = spark.createDataFrame([(0.5,), (0.25,)], "`it's a ``x``.y` double")
    assert df.agg(exact_sum(df, "it's a `x`.y")).first()[0] == 0.75
    with pytest.raises(Exception, match="it's a `x`.y can't be summed"):
        df.select((F.col("`it's a ``x``.y`") * float("inf")).alias("it's a `x`.y")).transform(lambda d: d.agg(exact_sum(d, "it's a `x`.y"))).collect()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=30))
def test_exact_sum_of_cents(spark, cents):
    assert summed(spark, [c / 100 for c in cents]) == nearest([c / 100 for c in cents])


def test_ratios_and_means(spark):
    df = spark.createDataFrame([(1, 0), (None, 4), (3, 2)], "a int, b int")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 1.5]
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [None, None, 150.0]
    assert df.agg(mean(F.col("a")), mean(F.col("a"), F.count("b"))).first()[:] == (2.0, 4 / 3)


def test_predicates(spark):
    df = spark.createDataFrame([(True, 1, 1), (False, 1, None), (None, None, None)], "p boolean, a int, b int")
    p, a, b = F.col("p"), F.col("a"), F.col("b")
    shown = df.select(
        logic.known(p), logic.is_true(p), logic.is_false(p), logic.is_not_true(p), logic.same(a, b), logic.differs(a, b)
    ).collect()
    assert [tuple(r) for r in shown] == [
        (True, True, False, False, True, False),
        (False, False, True, True, False, True),
        (False, False, False, True, True, False),
    ]
