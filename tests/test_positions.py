"""Positions against plain sorting."""

import pytest
from pyspark.sql import functions as F

from tripgrain.operators.positions import read_in_order, with_file_place, with_positions, write_in_order
from tripgrain.session import durable

SHAPE = "key string, n long, rows_before int, file_of_row string"


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"k{i % 3}" if i % 5 else None, (i * 37) % 101, i, "x") for i in range(2000)]
    return spark.createDataFrame(data, SHAPE).repartition(7)


def test_positions_are_those_of_a_sort(rows):
    order = (F.desc("n"), F.asc_nulls_last("key"), F.asc("rows_before"))
    got = with_positions(rows, *order).collect()
    want = sorted(rows.collect(), key=lambda r: (-r.n, r.key is None, r.key or "", r.rows_before))
    assert [tuple(r)[:4] for r in sorted(got, key=lambda r: r.position)] == [tuple(r) for r in want]
    assert sorted(r.position for r in got) == list(range(2000))
    assert got[0].__fields__ == [*rows.columns, "position"]


def test_positions_within_groups(rows):
    got = with_positions(rows, F.asc("key"), F.asc("n"), F.asc("rows_before"), name="slot", within=["key"]).collect()
    for key in {r.key for r in got}:
        mine = sorted((r for r in got if r.key == key), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        assert [(r.n, r.rows_before) for r in mine] == sorted((r.n, r.rows_before) for r in mine)


def test_empty_and_equal_rows(spark, rows):
    assert with_positions(rows.where("false"), F.asc("n"), within=["n"]).collect() == []
    equal = spark.createDataFrame([("a", 1, 1, "")] * 500, SHAPE).repartition(4)
    assert sorted(r.position for r in with_positions(equal, F.asc("n")).collect()) == list(range(500))


def test_file_places_tell_equal_rows_apart(spark):
    equal = durable(spark.createDataFrame([("a", 1, 1, "")] * 500, SHAPE).repartition(4), "equal")
    once, again = (sorted(map(tuple, with_file_place(equal, "f", "r").select("f", "r").collect())) for _ in range(2))
    assert once == again and len(set(once)) == 500


def test_many_files_keep_their_order(spark, rows, tmp_path):
    path = str(tmp_path / "ordered")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 97)
    try:
        write_in_order(rows, path, F.asc("n"), F.asc("rows_before"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = sorted(read_in_order(spark, path, rows.schema).collect(), key=lambda r: r.position)
    assert [(r.n, r.rows_before) for r in got] == sorted((r.n, r.rows_before) for r in got)
