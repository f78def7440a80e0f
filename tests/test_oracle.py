"""Every registered query against its SQL in DuckDB, on the smallest test data."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(entry.registered.registry()) == set(entry.oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.registered.registry()))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(entry.queries()[name](spark, FOLDER)) == sql_rows(con, SQL[name])
