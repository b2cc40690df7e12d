"""Every query of the core against its SQL counterpart, value by value; those of the llm package are tested apart."""

import pytest
from conftest import SMALL_SF

import __spark_entry__ as entry_point
from gate.compare import connect, difference
from gate.oracle import ORACLE
from gate.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL_SF)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLE.keys()


def test_the_driver_sees_every_query():
    assert QUERIES.keys() <= entry_point.queries().keys() and ORACLE.keys() <= entry_point.oracle_sql().keys()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


def test_flagship(spark):
    rows = entry_point.entry(spark).collect()
    assert [r.zone_rank for r in sorted(rows)] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem = difference(con, ORACLE[name], QUERIES[name](spark, SMALL_SF))
    assert problem is None, problem
