"""Windows, sessions, first sightings and joins of streams, over files that land one after another."""

import datetime

import pytest
from pyspark.sql import functions as F

from facetable.streaming import (
    first_seen,
    interval_join,
    late_rows,
    read_file_changes,
    session_totals,
    window_totals,
    write_events,
)

NOW = {"availableNow": True}
START = datetime.datetime(2024, 1, 1)
SCHEMA = "id int, k int, ts timestamp_ntz"


def at(minutes):
    return None if minutes is None else START + datetime.timedelta(minutes=minutes)


class Landing:
    """A folder in which batches land, and a stream over it with its checkpoint."""

    def __init__(self, spark, folder, name="a"):
        self.spark, self.folder, self.name, self.dropped = spark, folder, name, 0
        self.land([])

    def land(self, rows, name=None):
        frame = self.spark.createDataFrame([(i, k, at(m)) for i, k, m in rows], SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(f"{self.folder}/in-{name or self.name}")

    def stream(self, name=None):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return read_file_changes(self.spark, f"{self.folder}/in-{name or self.name}", schema, 0)

    def run(self, rows):
        """What a run adds to what was sent before."""
        sink = f"{self.folder}/out"
        query = write_events(rows, f"{self.folder}/checkpoint", options={"path": sink}, trigger=NOW)
        query.awaitTermination()
        self.dropped += late_rows(query)
        return sorted(map(tuple, self.spark.read.schema(rows.schema).parquet(sink).collect()), key=str)


def count():
    return [F.count("*").alias("n")]


def test_windows_are_sent_once_and_late_rows_counted(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    rows = lambda: window_totals(landing.stream(), "ts", "10 minutes", count(), ["k"], "5 minutes")
    landing.land([(1, 1, 1), (2, 1, 8), (3, None, 3), (4, 1, 12), (5, 1, None)])
    assert landing.run(rows()) == []  # the watermark is at 7
    landing.land([(6, 1, 9), (7, 1, 31)])  # late, but in time; then far ahead
    first = [(at(0), at(10), 1, 3), (at(0), at(10), None, 1), (at(10), at(20), 1, 1)]
    assert landing.run(rows()) == sorted(first, key=str) and landing.dropped == 0
    landing.land([(8, 1, 2), (9, 1, 15), (10, 1, 33), (11, 1, 60)])  # two too late
    done = landing.run(rows())
    assert landing.dropped == 2
    # Final windows equal the batch result over the rows that came in time.
    assert done == sorted([*first, (at(30), at(40), 1, 2)], key=str)
    assert landing.run(rows()) == done  # nothing is sent again


def test_sliding_windows(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.land([(1, 1, 7), (2, 1, 12), (3, 1, 90)])
    got = landing.run(window_totals(landing.stream(), "ts", "10 minutes", count(), [], "0 seconds", "5 minutes"))
    assert sorted(got) == [(at(0), at(10), 1), (at(5), at(15), 2), (at(10), at(20), 1)]


def test_sessions_merge_over_batches(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    rows = lambda: session_totals(landing.stream(), "ts", "10 minutes", count(), ["k"], "40 minutes")
    landing.land([(1, 1, 0), (2, 1, 18), (3, 2, 5), (4, 1, 40)])
    assert landing.run(rows()) == []
    landing.land([(5, 1, 9)])  # joins 0 and 18 into one session
    assert landing.run(rows()) == []
    landing.land([(6, 3, 85)])
    want = [(at(0), at(18), 1, 3), (at(5), at(5), 2, 1)]
    assert sorted(landing.run(rows())) == want
    landing.land([(7, 1, 20), (8, 3, 200)])  # too late to change a session that was sent
    want += [(at(40), at(40), 1, 1), (at(85), at(85), 3, 1)]
    assert sorted(landing.run(rows())) == want and landing.dropped == 1


def test_a_file_that_lands_again_sends_nothing_twice(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    batch = [(1, 1, 0), (2, 1, 4), (2, 1, 4), (3, None, 5)]
    landing.land(batch)
    rows = lambda: first_seen(landing.stream(), ["id"], "ts", "1 hour")
    want = [(1, 1, at(0)), (2, 1, at(4)), (3, None, at(5))]
    assert landing.run(rows()) == want
    landing.land(batch)
    landing.land([(4, 1, 6)])
    assert landing.run(rows()) == [*want, (4, 1, at(6))]


def test_interval_join_waits_for_partners(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.land([], "b")

    def rows():
        right = landing.stream("b").select(F.col("id").alias("id2"), F.col("k").alias("k2"), F.col("ts").alias("ts2"))
        return interval_join(
            landing.stream(), right, [("k", "k2")], "ts", "ts2", "5 minutes", "5 minutes", "10 minutes", "left"
        ).select("id", "id2")

    landing.land([(1, 1, 10), (2, 1, 20), (3, None, 10)])
    landing.land([(100, 1, 14), (101, 2, 10), (102, None, 10)], "b")
    assert landing.run(rows()) == [(1, 100)]
    landing.land([(103, 1, 15), (104, 1, 16)], "b")
    assert landing.run(rows()) == [(1, 100), (1, 103), (2, 103), (2, 104)]
    # Row 3 has no key and no partner: it is sent when none can come any more.
    landing.land([(4, 9, 90)])
    landing.land([(105, 8, 90)], "b")
    landing.run(rows())
    landing.land([(5, 9, 91)])
    landing.land([(106, 8, 91)], "b")
    assert landing.run(rows()) == [(1, 100), (1, 103), (2, 103), (2, 104), (3, None)]


def test_names_that_are_needed_are_refused(spark, tmp_path):
    stream = Landing(spark, tmp_path).stream().withColumnRenamed("k", "event_time")
    with pytest.raises(ValueError):
        window_totals(stream, "ts", "1 hour", count())
