"""Two- and three-valued predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(condition: Column) -> Column:
    """The condition with unknown taken as false: a missing measure never raises a flag."""
    return F.coalesce(condition, F.lit(False))


def is_true(condition: Column) -> Column:
    return condition.eqNullSafe(F.lit(True))


def is_false(condition: Column) -> Column:
    return condition.eqNullSafe(F.lit(False))


def is_not_true(condition: Column) -> Column:
    return ~is_true(condition)


def same(a: Column, b: Column) -> Column:
    """Equal, with two nulls being equal."""
    return a.eqNullSafe(b)


def differs(a: Column, b: Column) -> Column:
    """Distinct, with two nulls not being distinct."""
    return ~a.eqNullSafe(b)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
