"""Every registered query against DuckDB on the smallest tables."""

import pytest
from oracle import difference, duck

from millrace.catalog import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(name, spark, con):
    assert difference(all_queries()[name], all_sql().get(name), spark, con, FOLDER) is None
