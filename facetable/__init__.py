"""One table, four ways to read it: SQL, CSV, document queries and messages."""

from facetable.operators import (
    LOSSLESS_CSV,
    Children,
    asof_join,
    describe,
    describe_frame,
    document_query,
    export_csv,
    export_table,
    nested_query,
    overlap_join,
    preview,
    preview_text,
    project_filter,
    query_table,
    read_staged,
    run_sql,
    sessions,
    slice_by_range,
)
from facetable.plans import ModeNotEnabled, TableHandle, open_table
from facetable.session import build_session, drop_scratch
from facetable.sources import (
    TableNotFound,
    create_table,
    create_table_from_parquet,
    delete_rows,
    finish_changes,
    get_table,
    list_tables,
    parquet_view,
    read_parquet,
    scan_table,
    update_rows,
    upsert,
)
from facetable.streaming import (
    first_seen,
    fixed_start,
    from_events,
    interval_join,
    late_rows,
    read_changes,
    read_file_changes,
    run_for,
    session_totals,
    to_events,
    window_totals,
    write_events,
)

__all__ = [
    "Children",
    "LOSSLESS_CSV",
    "ModeNotEnabled",
    "TableHandle",
    "TableNotFound",
    "asof_join",
    "build_session",
    "create_table",
    "create_table_from_parquet",
    "delete_rows",
    "describe",
    "describe_frame",
    "document_query",
    "drop_scratch",
    "export_csv",
    "export_table",
    "finish_changes",
    "first_seen",
    "fixed_start",
    "from_events",
    "get_table",
    "interval_join",
    "late_rows",
    "list_tables",
    "nested_query",
    "open_table",
    "overlap_join",
    "parquet_view",
    "preview",
    "preview_text",
    "project_filter",
    "query_table",
    "read_changes",
    "read_file_changes",
    "read_parquet",
    "read_staged",
    "run_for",
    "run_sql",
    "scan_table",
    "session_totals",
    "sessions",
    "slice_by_range",
    "to_events",
    "update_rows",
    "upsert",
    "window_totals",
    "write_events",
]
