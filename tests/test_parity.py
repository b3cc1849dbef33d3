"""Every registered query against its DuckDB statement, at the smallest scale."""

import pytest

import __spark_entry__ as registered
from parity.catalog import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_all_of_them_are_registered():
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
