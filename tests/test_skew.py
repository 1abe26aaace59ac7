"""The SQL texts on tables where one key owns a third of the rows, and some keys are NULL.

The tables are made from the given ones; every text must still equal its oracle.
"""

import os

import pytest

from facetable.plans.oracle import ORACLE
from facetable.plans.registry import QUERIES, table_path
from facetable.plans.tables import TABLES
from tests.compare import duckdb_bag, open_duckdb, spark_bag

SOURCE = os.environ.get("TEST_SKEW_DIR", "/root/testdata/sf0.01")

SKEWED = {
    # Customer 7 owns a third of the orders, at few prices; no customer for some.
    "orders": """
        SELECT * REPLACE (
          CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 101 = 0 THEN NULL
               WHEN o_orderkey % 2 = 0 THEN o_orderkey + 1000000 ELSE o_custkey END AS o_custkey,
          CASE WHEN o_orderkey % 6 = 0 THEN 350000.25 WHEN o_orderkey % 33 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 3 = 0 THEN 'P' ELSE o_orderstatus END AS o_orderstatus)
        FROM orders
    """,
    # User 7 owns a third of the events, many at the same time; others have one.
    "events": """
        SELECT * REPLACE (
          CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 101 = 0 THEN NULL
               WHEN event_id % 2 = 0 THEN event_id + 1000000 ELSE user_id END AS user_id,
          CASE WHEN event_id % 9 = 0 THEN TIMESTAMP '2024-01-05 10:00:30'
               WHEN event_id % 9 = 3 THEN date_trunc('minute', ts) ELSE ts END AS ts,
          CASE WHEN event_id % 21 = 0 THEN NULL ELSE value END AS value)
        FROM events
    """,
    "customer": """
        SELECT * REPLACE (
          CASE WHEN c_custkey % 3 = 0 THEN 100.5 ELSE c_acctbal END AS c_acctbal,
          CASE WHEN c_custkey % 3 = 0 THEN 4 WHEN c_custkey % 50 = 1 THEN NULL
               ELSE c_nationkey END AS c_nationkey)
        FROM customer
    """,
    "supplier": """
        SELECT * REPLACE (
          CASE WHEN s_suppkey % 3 = 0 THEN 100.0 WHEN s_suppkey % 7 = 0 THEN NULL
               ELSE s_acctbal END AS s_acctbal)
        FROM supplier
    """,
    "lineitem": """
        SELECT * REPLACE (
          CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey)
        FROM lineitem
    """,
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    source = open_duckdb(SOURCE)
    for table in TABLES:
        select = SKEWED.get(table, f"SELECT * FROM {table}")
        # Several row groups, so that more than one task reads the large tables.
        source.execute(
            f"COPY ({select}) TO '{table_path(folder, table)}' "
            "(FORMAT parquet, ROW_GROUP_SIZE 4096)"
        )
    return folder


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("sql_", "asof_", "session_"))])
def test_sql_on_skewed_tables(spark, skewed, name):
    assert spark_bag(QUERIES[name](spark, skewed)) == duckdb_bag(
        open_duckdb(skewed), ORACLE[name]
    )


@pytest.fixture
def small_limits(spark):
    """Make a few kilobytes count as a skewed partition, and allow no broadcast."""
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16kb",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "64kb",
    }
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name", ["sql_join_inner", "sql_join_left", "sql_join_left_hot_right"]
)
def test_the_hot_side_of_a_join_is_split(spark, skewed, small_limits, name):
    frame = QUERIES[name](spark, skewed)
    assert spark_bag(frame) == duckdb_bag(open_duckdb(skewed), ORACLE[name])
    assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["sql_window_rank", "sql_window_frame", "sql_join_semi", "asof_purchases", "session_events"]
)
def test_results_do_not_depend_on_the_plan(spark, skewed, small_limits, name):
    assert spark_bag(QUERIES[name](spark, skewed)) == duckdb_bag(
        open_duckdb(skewed), ORACLE[name]
    )
