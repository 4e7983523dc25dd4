"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from ledgerlens.plans.registry import ORACLES, QUERIES
from tests.oracle_check import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []
