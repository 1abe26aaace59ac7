"""Streaming scans from a point in time, and the message writer."""

import time
from unittest.mock import MagicMock

import pytest

from facetable import (
    fixed_start,
    from_events,
    read_changes,
    read_file_changes,
    run_for,
    to_events,
    write_events,
)
from facetable.session import scratch_database
from facetable.streaming.changes import start_from_offset

NOW = {"availableNow": True}


@pytest.fixture
def table(spark, data):
    database = scratch_database(spark, "stream")
    name = f"{database}.events"
    rows = spark.read.parquet(f"{data}/events.parquet")
    rows.repartition(4).write.saveAsTable(name)
    yield name
    spark.sql(f"DROP DATABASE {database} CASCADE")


def send(spark, rows, checkpoint, sink):
    """Run a stream until nothing is left; the rows of each batch."""
    query = write_events(to_events(rows), checkpoint, options={"path": sink}, trigger=NOW)
    query.awaitTermination()
    return [progress["numInputRows"] for progress in query.recentProgress]


def sent(spark, sink):
    return spark.read.schema("data binary, key binary").parquet(sink).count()


def test_all_rows_once(spark, table, tmp_path):
    sink = str(tmp_path / "sink")
    send(spark, read_changes(spark, table, 0), str(tmp_path / "c"), sink)
    assert sent(spark, sink) == 1000
    back = from_events(spark.read.schema("data binary, key binary").parquet(sink))
    source = from_events(to_events(spark.table(table)))
    assert sorted(back.collect()) == sorted(source.collect())


def test_same_checkpoint_goes_on_and_a_new_one_repeats(spark, table, tmp_path):
    checkpoint, sink = str(tmp_path / "c"), str(tmp_path / "sink")
    send(spark, read_changes(spark, table, 0), checkpoint, sink)
    send(spark, read_changes(spark, table, 0), checkpoint, sink)
    assert sent(spark, sink) == 1000
    spark.table(table).limit(7).write.insertInto(table)
    send(spark, read_changes(spark, table, 0), checkpoint, sink)
    assert sent(spark, sink) == 1007
    send(spark, read_changes(spark, table, 0), str(tmp_path / "c2"), str(tmp_path / "again"))
    assert sent(spark, str(tmp_path / "again")) == 1007


def test_start_in_the_future_reads_nothing(spark, table, tmp_path):
    start = start_from_offset(3_600_000)
    batches = send(
        spark, read_changes(spark, table, start), str(tmp_path / "c"), str(tmp_path / "s")
    )
    assert sum(batches) == 0


def test_start_between_two_loads_sends_the_second(spark, table, tmp_path):
    time.sleep(1.1)
    start = start_from_offset(0)
    time.sleep(1.1)
    spark.table(table).limit(9).write.insertInto(table)
    sink = str(tmp_path / "s")
    send(spark, read_changes(spark, table, start), str(tmp_path / "c"), sink)
    assert sent(spark, sink) == 9


def test_batches_are_bounded(spark, table, tmp_path):
    one = read_changes(spark, table, 0, options={"maxFilesPerTrigger": "1"})
    assert send(spark, one, str(tmp_path / "c1"), str(tmp_path / "s1")) == [250] * 4
    few = read_changes(spark, table, 0, options={"maxBytesPerTrigger": "1"})
    assert send(spark, few, str(tmp_path / "c2"), str(tmp_path / "s2")) == [250] * 4


def test_latest_first_sends_all_rows_too(spark, table, tmp_path):
    options = {"latestFirst": "true", "maxFilesPerTrigger": "1"}
    sink = str(tmp_path / "s")
    send(spark, read_changes(spark, table, 0, options=options), str(tmp_path / "c"), sink)
    assert sent(spark, sink) == 1000


def test_a_run_that_is_cut_off_loses_and_repeats_nothing(spark, table, tmp_path):
    checkpoint, sink = str(tmp_path / "c"), str(tmp_path / "s")
    one = read_changes(spark, table, 0, options={"maxFilesPerTrigger": "1"})
    for _ in range(2):
        query = write_events(
            to_events(one), checkpoint, options={"path": sink}, trigger={"processingTime": "0 seconds"}
        )
        while not query.recentProgress:
            time.sleep(0.05)
        query.stop()
    send(spark, one, checkpoint, sink)
    back = from_events(spark.read.schema("data binary, key binary").parquet(sink))
    source = from_events(to_events(spark.table(table)))
    assert sorted(back.collect()) == sorted(source.collect())


def test_files_of_a_folder(spark, data, tmp_path):
    rows = spark.read.parquet(f"{data}/orders.parquet")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = read_file_changes(spark, str(tmp_path / "in"), rows.schema, 0)
    assert stream.isStreaming and stream.columns == rows.columns
    send(spark, stream, str(tmp_path / "c"), str(tmp_path / "s"))
    assert sent(spark, str(tmp_path / "s")) == rows.count()


def test_a_pattern_takes_one_file_like_a_folder(spark, data, tmp_path):
    rows = spark.read.parquet(f"{data}/orders.parquet")
    rows.repartition(3).write.parquet(str(tmp_path / "in" / "orders.parquet"))
    for number, base in enumerate((data, str(tmp_path / "in"))):
        stream = read_file_changes(spark, f"{base}/orders.parque[t]", rows.schema, 0)
        sink = str(tmp_path / f"s{number}")
        send(spark, stream, str(tmp_path / f"c{number}"), sink)
        assert sent(spark, sink) == rows.count()


def test_the_first_start_is_kept_for_later_runs(spark, tmp_path):
    checkpoint = str(tmp_path / "c")
    before = start_from_offset(-5000)
    first = fixed_start(spark, checkpoint, -5000)
    assert before <= first <= start_from_offset(-5000)
    time.sleep(0.01)
    assert fixed_start(spark, checkpoint, 0) == first
    assert fixed_start(spark, str(tmp_path / "other"), 0) > first


def test_a_start_left_half_written_is_written_again(spark, tmp_path):
    (tmp_path / "c.start").mkdir()
    start = fixed_start(spark, str(tmp_path / "c"), 0)
    assert fixed_start(spark, str(tmp_path / "c"), 0) == start


def test_a_snapshot_format_is_asked_by_its_option():
    spark = MagicMock()
    read_changes(spark, "db.t", 123, provider="iceberg", options={"o": "1"})
    spark.readStream.format.assert_called_once_with("iceberg")
    reader = spark.readStream.format.return_value.options
    reader.assert_called_once_with(o="1")
    reader.return_value.option.assert_called_once_with("stream-from-timestamp", "123")
    reader.return_value.option.return_value.load.assert_called_once_with("db.t")


def test_a_bounded_run_stops_its_query(spark, table, tmp_path):
    events = to_events(read_changes(spark, table, 0))
    sink = str(tmp_path / "s")
    query = write_events(events, str(tmp_path / "c"), options={"path": sink})
    assert run_for(query, 8) is False
    assert not query.isActive
    assert sent(spark, sink) == 1000


def test_a_run_that_ends_by_itself(spark, table, tmp_path):
    events = to_events(read_changes(spark, table, 0))
    query = write_events(events, str(tmp_path / "c"), fmt="noop", trigger=NOW)
    assert run_for(query, 60) is True


def test_sinks_are_parameters(spark, table, tmp_path):
    events = to_events(read_changes(spark, table, 0))
    query = write_events(
        events, str(tmp_path / "c"), "memory", {"queryName": "in_memory"}, NOW
    )
    query.awaitTermination()
    assert spark.table("in_memory").count() == 1000


def test_late_files_are_not_lost(spark, tmp_path):
    """A file whose time is eight days before the latest still goes out."""
    import os

    source, sink, checkpoint = (str(tmp_path / name) for name in ("source", "sink", "c"))
    spark.range(10).coalesce(1).write.parquet(source)
    schema = spark.range(1).schema
    send(spark, read_file_changes(spark, source, schema, 0), checkpoint, sink)
    spark.range(5).coalesce(1).write.mode("append").parquet(source)
    files = sorted((tmp_path / "source").glob("*.parquet"), key=os.path.getmtime)
    late = time.time() - 8 * 86400
    os.utime(files[-1], (late, late))
    send(spark, read_file_changes(spark, source, schema, 0), checkpoint, sink)
    assert sent(spark, sink) == 15
