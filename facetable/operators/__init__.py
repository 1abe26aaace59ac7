"""Reading a table by SQL or by document query, and writing it out."""

from facetable.operators.asof import asof_join
from facetable.operators.document import document_query
from facetable.operators.export import LOSSLESS_CSV, export_csv, export_table, read_staged
from facetable.operators.nested import Children, nested_query
from facetable.operators.overlap import overlap_join
from facetable.operators.ranges import slice_by_range
from facetable.operators.select import (
    describe,
    describe_frame,
    preview,
    preview_text,
    project_filter,
    query_table,
)
from facetable.operators.sessions import sessions
from facetable.operators.sql import run_sql

__all__ = [
    "Children",
    "LOSSLESS_CSV",
    "asof_join",
    "describe",
    "describe_frame",
    "document_query",
    "export_csv",
    "export_table",
    "nested_query",
    "overlap_join",
    "preview",
    "preview_text",
    "project_filter",
    "query_table",
    "read_staged",
    "run_sql",
    "sessions",
    "slice_by_range",
]
