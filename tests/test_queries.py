"""Every registered query against its SQL counterpart, on whole tables."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry_point
from touchtrail.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duck(SF)
    yield connection
    connection.close()


def test_every_query_has_a_counterpart():
    assert set(ORACLES) >= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(entry_point.queries()[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["channel", "first_click", "last_click"]
    assert result.count() > 0
