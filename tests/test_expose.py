"""The facade: modes and their gates."""

import pytest

from facetable import LOSSLESS_CSV, ModeNotEnabled, TableNotFound, from_events, open_table
from facetable.session import scratch_database
from tests.compare import spark_bag


@pytest.fixture
def handle(spark, data):
    database = scratch_database(spark, "expose")
    spark.read.parquet(f"{data}/customer.parquet").write.saveAsTable(f"{database}.customer")
    yield open_table(spark, f"{database}.customer")
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_there_must_be_a_table(spark):
    with pytest.raises(TableNotFound):
        open_table(spark, "default.nothing_here")


def test_reading_needs_the_mode(handle):
    for read in (
        handle.show_schema,
        lambda: handle.query_table(["c_name"]),
        lambda: handle.run_sql("SELECT 1"),
    ):
        with pytest.raises(ModeNotEnabled, match="SQL not enabled"):
            read()
    with pytest.raises(ModeNotEnabled, match="GQL not enabled"):
        handle.query_documents(["c_name"])


def test_one_mode_does_not_open_another(handle, tmp_path):
    handle.expose("SQL")
    with pytest.raises(ModeNotEnabled):
        handle.query_documents(["c_name"])
    handle.expose("CSV", directory=str(tmp_path))
    assert handle.modes == {"SQL", "CSV"}


def test_sql(handle):
    assert handle.expose("SQL").count() == 150
    assert handle.show_schema().first().col_name == "c_custkey"
    assert handle.query_table(["c_name"], ["c_acctbal > 5000"]).count() == 66
    text = f"SELECT count(*) AS n FROM {handle.table_name} WHERE c_acctbal > :low"
    assert handle.run_sql(text, {"low": 5000}).first().n == 66


def test_csv(spark, handle, tmp_path):
    path = handle.expose("CSV", directory=str(tmp_path), options=LOSSLESS_CSV)
    assert path == f"{tmp_path}/{handle.table_name}"
    table = spark.table(handle.table_name)
    back = spark.read.schema(table.schema).options(**LOSSLESS_CSV).csv(path)
    assert spark_bag(back) == spark_bag(table)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_gql_reads_a_snapshot(spark, handle, tmp_path, fmt):
    handle.expose("GQL", dataset=str(tmp_path / "staged"), fmt=fmt)

    def rich():
        return handle.query_documents(["c_custkey"], {"c_acctbal": {"_gt": 5000}}).count()

    assert rich() == 66
    spark.table(handle.table_name).where("c_acctbal > 5000").write.insertInto(handle.table_name)
    assert rich() == 66
    handle.expose("GQL", dataset=str(tmp_path / "staged"), fmt=fmt)
    assert rich() == 132


def test_event(spark, handle, tmp_path):
    sink = str(tmp_path / "sink")
    settings = {
        "checkpoint": str(tmp_path / "c"),
        "offset_ms": -1_000_000_000,
        "options": {"path": sink},
        "trigger": {"availableNow": True},
    }
    handle.expose("EVENT", **settings).awaitTermination()
    handle.expose("EVENT", **settings).awaitTermination()
    messages = spark.read.schema("data binary, key binary").parquet(sink)
    table = spark.table(handle.table_name)
    assert spark_bag(from_events(messages, table.schema)) == spark_bag(table)


def test_event_for_a_while(handle, tmp_path):
    query = handle.expose(
        "EVENT",
        checkpoint=str(tmp_path / "c"),
        offset_ms=-1_000_000_000,
        fmt="noop",
        stream_time=3,
    )
    assert not query.isActive and query.exception() is None


def test_unknown_mode(handle):
    with pytest.raises(ValueError):
        handle.expose("XML")


def test_a_mode_counts_once_its_work_is_done(handle, tmp_path):
    with pytest.raises(Exception):
        handle.expose("GQL", dataset=str(tmp_path), fmt="no-such-format")
    with pytest.raises(ModeNotEnabled):
        handle.query_documents(["c_name"])
    assert handle.modes == set()


def test_a_failed_repeat_closes_the_mode(handle, tmp_path):
    handle.expose("GQL", dataset=str(tmp_path))
    assert handle.query_documents(["c_name"]).count() == 150
    with pytest.raises(Exception):
        handle.expose("GQL", dataset=str(tmp_path), fmt="no-such-format")
    with pytest.raises(ModeNotEnabled):
        handle.query_documents(["c_name"])
