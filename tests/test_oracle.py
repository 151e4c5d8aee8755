"""Every registered query against its SQL, on the smallest data set."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
SQL = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], SQL[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
