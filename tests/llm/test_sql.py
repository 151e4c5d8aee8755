"""Queries of this part against their SQL."""

import pytest
from compare import connect, difference

from tabloop.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF_DIR), queries.QUERIES[name], queries.SQL[name], SF_DIR) is None
