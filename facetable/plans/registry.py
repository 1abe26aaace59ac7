"""Every query by name: how it runs here, and the same in another engine's SQL.

A query takes a session and the folder of the input tables and returns a frame.
Queries that write use the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetable.functions.envelope import parse_json
from facetable.operators import (
    LOSSLESS_CSV,
    Children,
    asof_join,
    describe,
    document_query,
    export_csv,
    export_table,
    nested_query,
    overlap_join,
    preview,
    project_filter,
    read_staged,
    run_sql,
    sessions,
    slice_by_range,
)
from facetable.plans.acceptance import ACCEPTANCE, ARGUMENTS, SLICED
from facetable.plans.expose import open_table
from facetable.plans.tables import TABLES
from facetable.session import scratch_database, scratch_path
from facetable.sources import (
    create_table_from_parquet,
    get_table,
    list_tables,
    parquet_view,
    read_parquet,
    scan_table,
)
from facetable.sources.changes import delete_rows, update_rows, upsert
from facetable.streaming import (
    first_seen,
    from_events,
    interval_join,
    read_changes,
    read_file_changes,
    session_totals,
    to_events,
    window_totals,
    write_events,
)

Query = Callable[[SparkSession, str], DataFrame]

ALL_AT_ONCE = {"availableNow": True}
MESSAGE = "data binary, key binary"


def table_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}.parquet"


def _input(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return read_parquet(spark, table_path(folder, table))


def _create(spark: SparkSession, folder: str, table: str, database: str) -> str:
    name = f"{database}.{table}"
    create_table_from_parquet(spark, table_path(folder, table), name)
    return name


def _register(spark: SparkSession, folder: str, table: str, database: str) -> str:
    """Give an input a name in the catalog; its files stay where they are."""
    location = table_path(folder, table).replace("'", "\\'")
    name = f"{database}.{table}"
    run_sql(spark, f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    return name


# Projection and filter


def project_filter_query(spark: SparkSession, folder: str) -> DataFrame:
    return project_filter(
        _input(spark, folder, "customer"),
        ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"],
        ["c_acctbal > 5000"],
    )


def project_filter_multi(spark: SparkSession, folder: str) -> DataFrame:
    return project_filter(
        _input(spark, folder, "customer"),
        ["c_custkey", "c_nationkey", "upper(c_mktsegment) AS segment"],
        ["c_acctbal < 0 OR c_acctbal > 9000", "c_nationkey < 10"],
    )


def project_filter_lines(spark: SparkSession, folder: str) -> DataFrame:
    return project_filter(
        _input(spark, folder, "lineitem"),
        ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"],
        ["l_quantity >= 45", "l_returnflag = 'R'"],
    )


def preview_query(spark: SparkSession, folder: str) -> DataFrame:
    return preview(_input(spark, folder, "orders").orderBy("o_orderkey"))


# Document queries


def document_query_page(spark: SparkSession, folder: str) -> DataFrame:
    return document_query(
        _input(spark, folder, "customer"),
        select=["c_custkey", "c_mktsegment", "c_name", "c_acctbal"],
        where={"c_acctbal": {"_gt": 5000}},
        limit=10,
        order_by={"c_custkey": "asc"},
    )


def document_query_filter(spark: SparkSession, folder: str) -> DataFrame:
    return document_query(
        _input(spark, folder, "customer"),
        select=["c_name", "c_custkey"],
        where={
            "_or": [
                {"c_acctbal": {"_gte": 9000}},
                {"_and": [{"c_acctbal": {"_lt": 0}}, {"c_nationkey": {"_in": [1, 2, 3]}}]},
            ],
            "c_name": {"_like": "Customer%", "_is_null": False},
            "_not": {"c_mktsegment": {"_eq": "BUILDING"}},
        },
    )


def document_query_offset(spark: SparkSession, folder: str) -> DataFrame:
    return document_query(
        _input(spark, folder, "orders"),
        select=["o_orderkey", "o_totalprice"],
        where={"o_orderstatus": {"_neq": "P"}},
        order_by={"o_totalprice": "desc", "o_orderkey": "asc"},
        offset=20,
        limit=30,
    )


def document_query_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their three dearest orders and their nation, a row per order."""
    orders = Children(
        _input(spark, folder, "orders"), [("c_custkey", "o_custkey")], ["o_orderkey", "o_totalprice"],
        limit=3, order_by={"o_totalprice": "desc", "o_orderkey": "asc"}, where={"o_orderstatus": {"_neq": "F"}},
    )
    nation = Children(
        _input(spark, folder, "nation"), [("c_nationkey", "n_nationkey")], ["n_name"],
        limit=1, order_by={"n_nationkey": "asc"},
    )
    documents = nested_query(
        _input(spark, folder, "customer"), ["c_custkey", "c_name"], {"orders": orders, "nation": nation},
        where={"c_acctbal": {"_gt": 5000}},
    )
    rows = documents.select("c_custkey", "c_name", F.col("nation.n_name")[0].alias("nation"), F.posexplode_outer("orders"))
    return rows.select("c_custkey", "c_name", "nation", F.col("pos").cast("long").alias("place"), "col.*")


# Messages


def event_envelope(spark: SparkSession, folder: str) -> DataFrame:
    events = to_events(_input(spark, folder, "events"))
    return events.select(
        F.decode("data", "UTF-8").alias("text"), F.decode("key", "UTF-8").alias("key")
    )


def event_envelope_keyed(spark: SparkSession, folder: str) -> DataFrame:
    events = to_events(_input(spark, folder, "lineitem"), key="l_orderkey")
    return events.select(
        F.decode("data", "UTF-8").alias("text"), F.decode("key", "UTF-8").alias("key")
    )


def event_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _input(spark, folder, "events")
    return from_events(to_events(rows), rows.schema)


def event_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _input(spark, folder, "documents")
    return from_events(to_events(rows, form="json"), rows.schema, form="json")


def _send(spark: SparkSession, rows: DataFrame, form: str) -> DataFrame:
    """Send all rows of a stream to files, and read the messages."""
    sink = scratch_path(spark, "messages")
    query = write_events(
        to_events(rows, form),
        checkpoint=scratch_path(spark, "checkpoint"),
        options={"path": sink},
        trigger=ALL_AT_ONCE,
    )
    query.awaitTermination()
    return spark.read.schema(MESSAGE).parquet(sink)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = table_path(folder, "events")
    # As a pattern, because Spark streams a single file only by one.
    pattern = f"{path[:-1]}[{path[-1]}]"
    return read_file_changes(spark, pattern, read_parquet(spark, path).schema, 0)


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    messages = _send(spark, _event_stream(spark, folder), "text")
    return from_events(messages, with_key=True)


def _sent(rows: DataFrame) -> DataFrame:
    """All rows that a stream sends until its input ends, from the files of its sink."""
    spark = rows.sparkSession
    sink = scratch_path(spark, "rows")
    query = write_events(rows, scratch_path(spark, "checkpoint"), options={"path": sink}, trigger=ALL_AT_ONCE)
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(sink)


def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each kind and hour that the watermark has passed."""
    totals = [F.count("*").alias("n_rows"), F.round(F.sum("value"), 3).alias("total")]
    events = _event_stream(spark, folder)
    return _sent(window_totals(events, "ts", "1 hour", totals, ["event_type"], "2 hours"))


def stream_sliding_windows(spark: SparkSession, folder: str) -> DataFrame:
    totals = [F.count("*").alias("n_rows")]
    events = _event_stream(spark, folder)
    return _sent(window_totals(events, "ts", "6 hours", totals, [], "2 hours", slide="3 hours"))


def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of each user that the watermark has passed."""
    totals = [F.count("*").alias("n_rows"), F.max("value").alias("largest")]
    events = _event_stream(spark, folder)
    return _sent(session_totals(events, "ts", "30 minutes", totals, ["user_id"], "1 hour"))


def stream_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """Every event sent twice passes once."""
    again = _event_stream(spark, folder).union(_event_stream(spark, folder))
    return _sent(first_seen(again, ["event_id"], "ts", "1 hour"))


def stream_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases with the clicks of their user in the ten minutes before."""
    purchases = _event_stream(spark, folder).where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = _event_stream(spark, folder).where("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("clicker"), F.col("ts").alias("clicked")
    )
    pairs = interval_join(
        purchases, clicks, [("user_id", "clicker")], "ts", "clicked", "10 minutes", "0 minutes", "1 hour"
    )
    return _sent(pairs.drop("clicker"))


def stream_events_parsed(spark: SparkSession, folder: str) -> DataFrame:
    table = _create(spark, folder, "conversations", scratch_database(spark, "stream"))
    schema = scan_table(spark, table).schema
    messages = _send(spark, read_changes(spark, table, start_ms=0), "json")
    return from_events(messages, schema, form="json")


# Exports


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _input(spark, folder, "documents")
    path = export_csv(rows, scratch_path(spark, "csv"), "documents", LOSSLESS_CSV)
    return read_staged(spark, path, "csv", LOSSLESS_CSV, schema=rows.schema)


def csv_default_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _input(spark, folder, "part")
    path = export_csv(rows, scratch_path(spark, "csv"), "part")
    return read_staged(spark, path, "csv", schema=rows.schema)


def csv_microseconds_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _input(spark, folder, "events")
    path = export_csv(rows, scratch_path(spark, "csv"), "events", LOSSLESS_CSV)
    return read_staged(spark, path, "csv", LOSSLESS_CSV, schema=rows.schema)


def csv_nested_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _input(spark, folder, "embeddings")
    path = export_csv(
        rows, scratch_path(spark, "csv"), "embeddings", LOSSLESS_CSV, nested="json"
    )
    flat = "vec_id long, embedding string, label int"
    stored = spark.read.schema(flat).options(**LOSSLESS_CSV).csv(path)
    vector = parse_json(F.col("embedding"), rows.schema["embedding"].dataType)
    return stored.select("vec_id", "label", F.posexplode_outer(vector).alias("place", "value")).select(
        "vec_id", "label", F.col("place").cast("long"), F.col("value").cast("double")
    )


def staged_export(spark: SparkSession, folder: str) -> DataFrame:
    rows = _input(spark, folder, "lineitem")
    target = export_table(rows, scratch_path(spark, "staged"), "sales.lineitem")
    return read_staged(spark, target)


def staged_export_orc(spark: SparkSession, folder: str) -> DataFrame:
    rows = _input(spark, folder, "orders")
    target = export_table(rows, scratch_path(spark, "staged"), "sales.orders", "orc")
    return read_staged(spark, target, "orc", schema=rows.schema)


# Tables and the catalog


def table_create_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_table(
        spark, _create(spark, folder, "orders", scratch_database(spark, "create"))
    )


def table_describe(spark: SparkSession, folder: str) -> DataFrame:
    return describe(
        spark, _register(spark, folder, "customer", scratch_database(spark, "describe"))
    )


def catalog_list(spark: SparkSession, folder: str) -> DataFrame:
    """Name all inputs in a new database; count the rows of each table it lists.

    The tables stay where they are: DDL gives the catalog their locations.
    """
    database = scratch_database(spark, "catalog")
    for table in TABLES:
        _register(spark, folder, table, database)
    listed = list_tables(spark).where(F.col("database") == database)
    counted = None
    for entry in listed.select("table", "full_name").collect():
        rows = get_table(spark, entry.full_name).agg(F.count(F.lit(1)).alias("n_rows"))
        name = entry.full_name.removeprefix(f"{database}.")
        rows = rows.select(
            F.lit(entry["table"]).alias("table_name"), F.lit(name).alias("name"), "n_rows"
        )
        counted = rows if counted is None else counted.union(rows)
    return counted


# The facade


def expose_sql(spark: SparkSession, folder: str) -> DataFrame:
    name = _register(spark, folder, "customer", scratch_database(spark, "expose"))
    handle = open_table(spark, name)
    handle.expose("SQL")
    return handle.query_table(
        ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"], ["c_acctbal > 5000"]
    )


def expose_csv(spark: SparkSession, folder: str) -> DataFrame:
    name = _register(spark, folder, "pages", scratch_database(spark, "expose"))
    handle = open_table(spark, name)
    path = handle.expose("CSV", directory=scratch_path(spark, "csv"), options=LOSSLESS_CSV)
    schema = scan_table(spark, name).schema
    return read_staged(spark, path, "csv", LOSSLESS_CSV, schema=schema)


def expose_gql(spark: SparkSession, folder: str) -> DataFrame:
    name = _register(spark, folder, "customer", scratch_database(spark, "expose"))
    handle = open_table(spark, name)
    handle.expose("GQL", dataset=scratch_path(spark, "staged"))
    return handle.query_documents(
        ["c_custkey", "c_mktsegment", "c_name", "c_acctbal"], {"c_acctbal": {"_gt": 5000}}
    )


def expose_event(spark: SparkSession, folder: str) -> DataFrame:
    name = _create(spark, folder, "orders", scratch_database(spark, "expose"))
    handle = open_table(spark, name)
    sink = scratch_path(spark, "messages")
    query = handle.expose(
        "EVENT",
        checkpoint=scratch_path(spark, "checkpoint"),
        offset_ms=-1_000_000_000,
        options={"path": sink},
        trigger=ALL_AT_ONCE,
    )
    query.awaitTermination()
    return from_events(spark.read.schema(MESSAGE).parquet(sink), with_key=True)


# SQL text


def _acceptance(spark: SparkSession, folder: str, name: str) -> DataFrame:
    tables, text = ACCEPTANCE[name]
    for table in tables:
        parquet_view(spark, table_path(folder, table), table)
    if name in SLICED:
        view, table, columns, order = SLICED[name]
        rows = _input(spark, folder, table).select(*columns)
        slice_by_range(rows, list(map(_ordered, order))).createOrReplaceTempView(view)
    return run_sql(spark, text, ARGUMENTS.get(name))


def _ordered(item: str) -> Column:
    """An item of an ORDER BY, with Spark's order of NULLs."""
    name, _, down = item.partition(" ")
    return F.col(name).desc() if down else F.col(name).asc()


def sql_ddl_dml(spark: SparkSession, folder: str) -> DataFrame:
    """CREATE TABLE AS and INSERT INTO by SQL, then a query on the result."""
    database = scratch_database(spark, "ddl")
    parquet_view(spark, table_path(folder, "orders"), "orders")
    run_sql(
        spark,
        f"CREATE TABLE {database}.open_orders USING parquet AS "
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'",
    )
    run_sql(
        spark,
        f"INSERT INTO {database}.open_orders "
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'",
    )
    return run_sql(spark, f"SELECT o_orderkey, o_totalprice FROM {database}.open_orders;")


def table_changes(spark: SparkSession, folder: str) -> DataFrame:
    """An update, a delete and an upsert on a table that is partitioned by status."""
    name = f"{scratch_database(spark, 'changes')}.orders"
    journal = scratch_path(spark, "journal")
    orders = _input(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    orders.write.partitionBy("o_orderstatus").saveAsTable(name)
    update_rows(spark, name, {"o_totalprice": "o_totalprice * 2"}, "o_orderstatus = 'P'", journal)
    delete_rows(spark, name, "o_orderstatus = 'O' AND o_totalprice < 50000", journal)
    returned = orders.where("o_orderstatus = 'F' AND o_orderpriority LIKE '1%'").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.lit("R").alias("o_orderstatus"), "o_orderpriority",
    )
    upsert(returned, name, ["o_orderkey"], journal)
    return scan_table(spark, name)


# Ordered work on keys of any size


def asof_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Each event with the latest purchase of its user before it."""
    events = _input(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    purchases = _input(spark, folder, "events").where("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchased"), "value"
    )
    return asof_join(
        events, purchases, ["user_id"], "ts", "purchased", ["purchase_id", "purchased", "value"],
        ties=["purchase_id"], same_time=False,
    )


def session_events(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of each user, with pauses below half an hour."""
    found = sessions(
        _input(spark, folder, "events"), ["user_id"], "ts", 1800,
        {"total": ("sum", "value"), "largest": ("max", "value")},
    )
    return found.withColumn("total", F.round("total", 3))


def overlap_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """For each session of a user, how many sessions of others lie in the same time."""
    mine = sessions(_input(spark, folder, "events"), ["user_id"], "ts", 1800).drop("n_rows")
    others = mine.toDF("other_id", "other_start", "other_end")
    spans = ("session_start", "session_end"), ("other_start", "other_end")
    pairs = overlap_join(mine, others, *spans, smallest_seconds=300, n_sizes=4).where("user_id <> other_id")
    return pairs.groupBy("user_id", "session_start", "session_end").agg(F.count("*").alias("n_others"))


QUERIES: dict[str, Query] = {
    "project_filter": project_filter_query,
    "project_filter_multi": project_filter_multi,
    "project_filter_lines": project_filter_lines,
    "preview": preview_query,
    "document_query": document_query_page,
    "document_query_filter": document_query_filter,
    "document_query_offset": document_query_offset,
    "document_query_nested": document_query_nested,
    "event_envelope": event_envelope,
    "event_envelope_keyed": event_envelope_keyed,
    "event_roundtrip": event_roundtrip,
    "event_json_roundtrip": event_json_roundtrip,
    "stream_events": stream_events,
    "stream_events_parsed": stream_events_parsed,
    "stream_windows": stream_windows,
    "stream_sliding_windows": stream_sliding_windows,
    "stream_sessions": stream_sessions,
    "stream_first_seen": stream_first_seen,
    "stream_interval_join": stream_interval_join,
    "csv_roundtrip": csv_roundtrip,
    "csv_default_roundtrip": csv_default_roundtrip,
    "csv_microseconds_roundtrip": csv_microseconds_roundtrip,
    "csv_nested_roundtrip": csv_nested_roundtrip,
    "staged_export": staged_export,
    "staged_export_orc": staged_export_orc,
    "table_create_scan": table_create_scan,
    "table_changes": table_changes,
    "describe": table_describe,
    "catalog_list": catalog_list,
    "expose_sql": expose_sql,
    "expose_csv": expose_csv,
    "expose_gql": expose_gql,
    "expose_event": expose_event,
    "sql_ddl_dml": sql_ddl_dml,
    "asof_purchases": asof_purchases,
    "session_events": session_events,
    "overlap_sessions": overlap_sessions,
    **{name: partial(_acceptance, name=name) for name in ACCEPTANCE},
}
