"""Queries of this package against their SQL, value by value."""

import pytest
from conftest import SMALL_SF

from gate.compare import connect, difference
from tripgrain.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL_SF)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, con, name):
    problem = difference(con, ORACLE[name], QUERIES[name](spark, SMALL_SF))
    assert problem is None, problem
