"""Every registered query against the same result from DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from facetable.plans.oracle import ORACLE
from facetable.plans.registry import QUERIES
from tests.compare import duckdb_bag, open_duckdb, spark_bag


@pytest.fixture(scope="module")
def duck(data):
    return open_duckdb(data)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 66


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, data, duck, name):
    names, rows = spark_bag(QUERIES[name](spark, data))
    expected_names, expected = duckdb_bag(duck, ORACLE[name])
    assert names == expected_names
    assert rows == expected
