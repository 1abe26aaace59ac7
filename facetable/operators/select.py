"""Describe, project, filter, preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from facetable.operators.sql import run_sql

# Size of a text preview.
PREVIEW_ROWS = 100
PREVIEW_WIDTH = 20


def describe(spark: SparkSession, table_name: str) -> DataFrame:
    """The schema of a table as (col_name, data_type, comment)."""
    return run_sql(spark, "DESCRIBE TABLE IDENTIFIER(:table)", {"table": table_name})


def describe_frame(frame: DataFrame) -> DataFrame:
    """The same three columns for a frame that has no name in the catalog."""
    rows = [
        (field.name, field.dataType.simpleString(), field.metadata.get("comment"))
        for field in frame.schema
    ]
    schema = "col_name string, data_type string, comment string"
    return frame.sparkSession.createDataFrame(rows, schema).coalesce(1)


def project_filter(
    frame: DataFrame, projections: Sequence[str], predicates: Sequence[str] = ()
) -> DataFrame:
    """Rows that meet every predicate, reduced to the projections in their order.

    Each predicate is one condition, whatever it holds: ``["a OR b", "c"]`` means
    ``(a OR b) AND c``.  No predicate keeps all rows.
    """
    _refuse_text(projections, "projections")
    _refuse_text(predicates, "predicates")
    if not projections:
        raise ValueError("name at least one column or expression to select")
    for predicate in predicates:
        frame = frame.where(predicate)
    return frame.selectExpr(*projections)


def query_table(
    spark: SparkSession,
    table_name: str,
    projections: Sequence[str],
    predicates: Sequence[str] = (),
) -> DataFrame:
    """:func:`project_filter` on a table of the catalog."""
    return project_filter(spark.table(table_name), projections, predicates)


def preview(frame: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """At most ``rows`` rows, gathered in one task; which ones is open unless the frame
    is sorted."""
    return frame.limit(rows)


def preview_text(
    frame: DataFrame, rows: int = PREVIEW_ROWS, width: int = PREVIEW_WIDTH
) -> str:
    """The same as a text table whose cells are cut to ``width`` characters."""
    return frame._show_string(rows, truncate=width) + "\n"


def _refuse_text(value: Sequence[str], what: str) -> None:
    if isinstance(value, str):
        raise TypeError(f"{what} must be a list of strings, not one string")
