"""Where tables come from: Parquet folders and the catalog."""

from facetable.sources.catalog import (
    TableNotFound,
    create_table,
    create_table_from_parquet,
    get_table,
    list_tables,
    scan_table,
)
from facetable.sources.changes import delete_rows, finish_changes, update_rows, upsert
from facetable.sources.files import parquet_view, read_parquet

__all__ = [
    "TableNotFound",
    "create_table",
    "create_table_from_parquet",
    "delete_rows",
    "finish_changes",
    "get_table",
    "list_tables",
    "parquet_view",
    "read_parquet",
    "scan_table",
    "update_rows",
    "upsert",
]
