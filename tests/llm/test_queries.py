"""Queries against DuckDB on the smallest tables."""

import pytest

from check import connect, differences
from recordwash.llm.oracle import ORACLE_SQL
from recordwash.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_same_rows_as_duckdb(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), name, sf_dir) == ""


def test_every_operator_has_its_query():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
