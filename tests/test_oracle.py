"""Every registered query against SQL in DuckDB, on the smallest tables."""

import pytest
from compare import connect, difference
from conftest import SMALL

import __spark_entry__ as entry
from tallgrass.plans import oracle, queries as registered

QUERIES = registered.all_queries()
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def con():
    connection = connect(SMALL)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
