"""Run a query here and its SQL in DuckDB, and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

from facetable.plans.registry import table_path
from facetable.plans.tables import TABLES


def open_duckdb(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{table_path(folder, table)}'"
        )
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return value


def typed(value):
    return (type(value).__name__, plain(value))


def bag(rows, names) -> Counter:
    """Rows as a multiset, columns sorted by name."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(typed(row[i]) for i in order) for row in rows)


def spark_bag(frame) -> tuple[list[str], Counter]:
    return sorted(frame.columns), bag(frame.collect(), frame.columns)


def duckdb_bag(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), bag(cursor.fetchall(), names)
