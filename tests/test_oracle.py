"""Every query against DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, differences
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_duckdb(spark, connection, sf_dir, name):
    assert differences(spark, connection, name, sf_dir) == ""


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= queries().keys()
    assert oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
