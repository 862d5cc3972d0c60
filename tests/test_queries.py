"""Every query with a SQL statement gives the same rows on the smallest tables."""

import pytest
from compare import connect, difference
from conftest import SMALL

import __spark_entry__ as entry

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SMALL), con, SQL[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
