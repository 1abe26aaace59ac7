"""What Spark makes of the queries: pushed filters, pruned columns, few shuffles."""

import re

import pytest

from facetable import to_events
from facetable.plans.registry import QUERIES


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize(
    ("name", "filters"),
    [
        ("project_filter", "GreaterThan(c_acctbal,5000.0)"),
        ("project_filter_multi", "LessThan(c_nationkey,10)"),
        ("project_filter_lines", "EqualTo(l_returnflag,R)"),
        ("document_query", "GreaterThan(c_acctbal,5000.0)"),
        ("document_query_filter", "StringStartsWith(c_name,Customer)"),
        ("sql_parameters", "EqualTo(c_mktsegment,BUILDING)"),
    ],
)
def test_filters_reach_the_scan(spark, data, name, filters):
    assert filters in plan(QUERIES[name](spark, data))


def test_only_needed_columns_are_read(spark, data):
    text = plan(QUERIES["project_filter_lines"](spark, data))
    columns = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert [column.split(":")[0] for column in columns.split(",")] == [
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
    ]


@pytest.mark.parametrize(
    "name",
    [
        "project_filter",
        "project_filter_multi",
        "project_filter_lines",
        "document_query_filter",
        "event_envelope",
        "event_envelope_keyed",
        "event_roundtrip",
        "event_json_roundtrip",
        "csv_roundtrip",
        "staged_export",
        "expose_gql",
        "sql_scalar_funcs",
        "sql_array_funcs",
        "sql_json_funcs",
    ],
)
def test_row_by_row_work_does_not_shuffle(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", ["document_query", "document_query_offset", "sql_topk", "preview"])
def test_order_and_limit_are_a_top_k(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_top_per_key_is_cut_before_the_shuffle(spark, data):
    text = plan(QUERIES["sql_window_top"](spark, data))
    assert text.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", sorted(name for name in QUERIES if name.startswith("sql_")))
def test_no_nested_loops(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_grouping_sets_expand_counts_not_rows(spark, data):
    for name in ("sql_rollup", "sql_cube", "sql_grouping_sets"):
        tree = plan(QUERIES[name](spark, data)).split("\n\n")[0]
        assert tree.index("Expand") < tree.index("Exchange", tree.index("Expand"))


def test_messages_are_one_projection(spark, data):
    rows = spark.read.parquet(f"{data}/events.parquet")
    tree = plan(to_events(rows)).split("\n\n")[0]
    assert re.findall(r"[A-Z]\w+", tree.split("\n", 1)[1]) == [
        "Project",
        "ColumnarToRow",
        "Scan",
    ]
