"""Slices of a total order, and what is built on them: as-of joins and sessions."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from facetable.operators import asof_join, sessions, slice_by_range
from facetable.operators.ranges import carried, spanning_keys
from facetable.plans.registry import QUERIES

START = datetime.datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else START + datetime.timedelta(seconds=seconds)



def _planned(frame):
    spark = frame.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return frame.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


# Slices


def test_slices_follow_the_order_and_cut_a_hot_key(spark):
    rows = [(7 if k % 3 else k, k % 50, k) for k in range(3000)]
    frame = spark.createDataFrame(rows, "a int, b int, c int")
    sliced = slice_by_range(frame, ["a", "b", "c"], 10)
    got = sorted(tuple(r) for r in sliced.collect())
    assert [r[:3] for r in got] == sorted(rows)
    assert [r[3] for r in got] == sorted(r[3] for r in got)  # numbers go up with the order
    assert max(Counter(r[3] for r in got).values()) <= 2 * 300
    assert [r.a for r in spanning_keys(sliced, ["a"]).collect()] == [7]
    with pytest.raises(ValueError):
        slice_by_range(sliced, ["a"])


def test_carried_values(spark):
    state = spark.createDataFrame([(1, 0, "x"), (1, 1, None), (1, 2, "y"), (1, 3, None), (2, 3, "z")], "a int, slice int, v string")
    assert sorted(map(tuple, carried(state, ["a"], "v").collect())) == [(1, 1, "x"), (1, 2, "x"), (1, 3, "y")]


# As-of joins


def latest(left, right, same_time):
    """By hand: rows are (id, key, seconds)."""
    out = []
    for i, key, when in left:
        found = [
            (t, n) for n, k, t in right
            if None not in (key, k, when, t) and k == key and (t < when or (same_time and t == when))
        ]
        out.append((i, key, at(when), max(found)[1] if found else None))
    return Counter(out)


@pytest.mark.parametrize("same_time", [True, False])
@pytest.mark.parametrize("slices", [None, 1, 13])
def test_asof_join(spark, same_time, slices):
    rng = random.Random(4)
    key = lambda: rng.choice([7, 7, 7, 1, 2, 3, None, rng.randrange(100)])
    when = lambda: rng.choice([None, *[rng.randrange(300)] * 12])
    left = [(k, key(), when()) for k in range(900)] + [(0, 7, 5)] * 3
    right = [(k, key(), when()) for k in range(400)]
    frames = [
        spark.createDataFrame([(i, k, at(t)) for i, k, t in rows], f"{name} int, {keyed} int, {time} timestamp_ntz")
        for rows, name, keyed, time in ((left, "id", "k", "ts"), (right, "n", "k", "ts"))
    ]
    got = asof_join(*frames, ["k"], "ts", "ts", ["n"], ties=["n"], same_time=same_time, slices=slices)
    assert got.columns == ["id", "k", "ts", "n"]
    assert Counter(map(tuple, got.collect())) == latest(left, right, same_time)


def test_asof_join_edges(spark):
    left = spark.createDataFrame([(1, 1, at(5))], "id int, slice_ int, ts timestamp_ntz").withColumnRenamed("slice_", "k0")
    right = left.select("k0", "ts", F.col("id").alias("r"))
    assert asof_join(left, right.where("FALSE"), ["k0"], "ts", "ts", ["r"]).collect() == [(1, 1, at(5), None)]
    assert asof_join(left.where("FALSE"), right, ["k0"], "ts", "ts", ["r"]).count() == 0
    assert asof_join(left, right, ["k0"], "ts", "ts", ["r"]).collect() == [(1, 1, at(5), 1)]
    with pytest.raises(ValueError):
        asof_join(left, right, ["k0"], "ts", "ts", ["ts"])


def test_asof_join_shuffles_rows_once_behind_their_slices(spark, data):
    plan = _planned(QUERIES["asof_purchases"](spark, data))
    # Rows by key and slice; one row per key and slice, twice.
    assert plan.count("Exchange hashpartitioning") <= 3
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan


# Sessions


def by_hand(rows, gap):
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted(((t, v) for k, t, v in rows if k == key and t is not None), key=lambda x: x[0])
        part = []
        for t, v in [*mine, (None, None)]:
            if part and (t is None or t - part[-1][0] >= gap):
                values = [x for _, x in part if x is not None]
                out.append((key, at(part[0][0]), at(part[-1][0]), len(part), sum(values) if values else None, len(values)))
                part = []
            part.append((t, v))
    return Counter(out)


@pytest.mark.parametrize("slices", [None, 1, 9, 40])
def test_sessions(spark, slices):
    rng = random.Random(8)
    rows = [(rng.choice([7, 7, 1, None, rng.randrange(60)]), rng.choice([None, *[rng.randrange(20000)] * 9]), rng.choice([None, 1, 2])) for _ in range(1500)]
    rows += [(9, 100, 5)] * 200  # many at one time
    rows += [(8, 10 * k, 1) for k in range(600)]  # one session over many slices
    rows += [(6, 30 * k, 1) for k in range(300)]  # a pause of exactly the gap
    frame = spark.createDataFrame([(k, at(t), v) for k, t, v in rows], "slice_of int, ts timestamp_ntz, value int")
    got = sessions(frame, ["slice_of"], "ts", 30, {"total": ("sum", "value"), "n": ("count", "value")}, slices)
    assert Counter(map(tuple, got.collect())) == by_hand(rows, 30)


def test_sessions_equal_those_of_spark(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    theirs = events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    theirs = theirs.select("user_id", F.col("w.start"), (F.col("w.end") - F.expr("INTERVAL 30 MINUTE")), "n")
    ours = sessions(events, ["user_id"], "ts", 1800, slices=7)
    assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, theirs.collect()))


def test_no_sessions(spark):
    frame = spark.createDataFrame([(1, None)], "a int, ts timestamp_ntz")
    assert sessions(frame, ["a"], "ts", 30).count() == sessions(frame.where("FALSE"), ["a"], "ts", 30).count() == 0
    with pytest.raises(ValueError):
        sessions(frame, ["a"], "ts", 30, {"m": ("median", "a")})


@pytest.mark.parametrize("name", ["sql_window_rank", "sql_window_frame", "session_events"])
def test_windows_over_slices_take_few_exchanges(spark, data, name):
    assert _planned(QUERIES[name](spark, data)).count("Exchange hashpartitioning") <= 6
