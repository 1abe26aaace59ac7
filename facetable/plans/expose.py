"""One table, readable in the modes it has been exposed in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from facetable.operators.document import document_query
from facetable.operators.export import export_csv, export_table, read_staged
from facetable.operators.nested import Children, nested_query
from facetable.operators.select import describe, query_table
from facetable.operators.sql import run_sql
from facetable.sources.catalog import find_table, scan_table
from facetable.streaming.changes import fixed_start, read_changes
from facetable.streaming.events import run_for, to_events, write_events

# Names of the modes.
SQL, CSV, GQL, EVENT = "SQL", "CSV", "GQL", "EVENT"


class ModeNotEnabled(RuntimeError):
    """The table was read through a mode it has not been exposed in."""


def open_table(spark: SparkSession, table_name: str) -> TableHandle:
    """A handle on a table of the catalog; raises when there is no such table."""
    return TableHandle(spark, find_table(spark, table_name))


class TableHandle:
    """A table and the modes it is exposed in.

    A mode counts as exposed once its work has succeeded.
    """

    def __init__(self, spark: SparkSession, table_name: str):
        self.spark = spark
        self.table_name = table_name
        self.modes: set[str] = set()
        self._documents: DataFrame | None = None

    def expose(self, mode: str, **settings: Any) -> DataFrame | str | StreamingQuery:
        """Expose the table in one more mode.

        ========  ==========================================  ====================
        mode      settings                                    returns
        ========  ==========================================  ====================
        SQL       none                                        the table as a frame
        CSV       directory, options, nested                  the path written
        GQL       dataset, fmt, options, name_option          the staged copy
        EVENT     checkpoint, offset_ms, start_ms, provider,  the streaming query
                  read_options, form, key, fmt, options,
                  trigger, stream_time
        ========  ==========================================  ====================
        """
        steps = {
            SQL: self._expose_sql,
            CSV: self._expose_csv,
            GQL: self._expose_gql,
            EVENT: self._expose_event,
        }
        if mode not in steps:
            raise ValueError(f"unknown mode {mode!r}; one of {', '.join(steps)}")
        # Exposing again overwrites; if that fails, what was there is gone too.
        self.modes.discard(mode)
        result = steps[mode](**settings)
        self.modes.add(mode)
        return result

    def show_schema(self) -> DataFrame:
        """(col_name, data_type, comment) of the table."""
        self._need(SQL)
        return describe(self.spark, self.table_name)

    def query_table(
        self, projections: Sequence[str], predicates: Sequence[str] = ()
    ) -> DataFrame:
        """Projected rows that meet every predicate."""
        self._need(SQL)
        return query_table(self.spark, self.table_name, projections, predicates)

    def run_sql(self, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
        """Any one SQL statement, on this table or others."""
        self._need(SQL)
        return run_sql(self.spark, text, args)

    def query_documents(
        self,
        select: Sequence[str],
        where: Mapping[str, Any] | None = None,
        limit: int | None = None,
        order_by: Mapping[str, str] | None = None,
        offset: int | None = None,
        children: Mapping[str, Children] | None = None,
    ) -> DataFrame:
        """A document query on the copy staged when the mode was exposed.

        ``children`` adds arrays of rows of other tables.
        """
        self._need(GQL)
        if children:
            return nested_query(self._documents, select, children, where, limit, order_by, offset)
        return document_query(self._documents, select, where, limit, order_by, offset)

    def _need(self, mode: str) -> None:
        if mode not in self.modes:
            raise ModeNotEnabled(f"{mode} not enabled on {self.table_name}")

    def _expose_sql(self) -> DataFrame:
        return scan_table(self.spark, self.table_name)

    def _expose_csv(self, directory: str, **settings: Any) -> str:
        frame = scan_table(self.spark, self.table_name)
        return export_csv(frame, directory, self.table_name, **settings)

    def _expose_gql(
        self,
        dataset: str,
        fmt: str = "parquet",
        options: Mapping[str, str] | None = None,
        name_option: str = "table",
    ) -> DataFrame:
        frame = scan_table(self.spark, self.table_name)
        target = export_table(frame, dataset, self.table_name, fmt, options, name_option)
        self._documents = read_staged(
            self.spark, target, fmt, options, name_option, frame.schema
        )
        return self._documents

    def _expose_event(
        self,
        checkpoint: str,
        offset_ms: int = 0,
        start_ms: int | None = None,
        provider: str | None = None,
        read_options: Mapping[str, str] | None = None,
        form: str = "text",
        key: str | None = None,
        fmt: str = "parquet",
        options: Mapping[str, str] | None = None,
        trigger: Mapping[str, object] | None = None,
        stream_time: float | None = None,
    ) -> StreamingQuery:
        if start_ms is None:
            start_ms = fixed_start(self.spark, checkpoint, offset_ms)
        rows = read_changes(self.spark, self.table_name, start_ms, provider, read_options)
        query = write_events(to_events(rows, form, key), checkpoint, fmt, options, trigger)
        if stream_time is not None:
            run_for(query, stream_time)
        return query
