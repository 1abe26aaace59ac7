"""The SQL texts on values and groups that the given tables do not hold."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from facetable.operators import slice_by_range
from facetable.plans.acceptance import ACCEPTANCE, SLICED
from facetable.plans.registry import _ordered

NAN = float("nan")
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"
EVENTS = "event_id long, user_id long, ts timestamp_ntz, value double"


def run(spark, name, rows, schema, table):
    """A text on some rows."""
    spark.createDataFrame(rows, schema).createOrReplaceTempView(table)
    return spark.sql(ACCEPTANCE[name][1])


def test_small_values_are_summed(spark):
    rows = [(i, 1, "O", 0.004) for i in range(1000)]
    (row,) = run(spark, "sql_group_agg", rows, ORDERS, "orders").collect()
    assert (row.orders, row.total, row.mean) == (1000, 4.0, 0.004)
    rows += [(i, 2, "O", 0.001) for i in range(1000)]
    assert [tuple(r) for r in run(spark, "sql_cte_subquery", rows, ORDERS, "orders").collect()] == [
        (1, 4.0)
    ]


def test_nan_goes_through_a_sum(spark):
    (row,) = run(spark, "sql_group_agg", [(1, 1, "O", NAN), (2, 1, "O", 1.0)], ORDERS, "orders").collect()
    assert row.orders == 2 and math.isnan(row.total)


def ranks(rows):
    """Places by hand: NaN first, no price last, then by order key."""
    key = lambda r: (r[3] is None, 0 if r[3] is None else -math.inf if math.isnan(r[3]) else -r[3], r[0])
    places = {}
    for customer in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == customer), key=key)
        places |= {r[0]: i + 1 for i, r in enumerate(mine)}
    return places


SLICES = 16


def run_sliced(spark, name, rows, schema):
    """A text on rows that are cut into many slices; all groups of its windows are small."""
    view, _, columns, order = SLICED[name]
    frame = spark.createDataFrame(rows, schema).select(*columns)
    sliced = slice_by_range(frame, list(map(_ordered, order)), SLICES)
    sliced.createOrReplaceTempView(view)
    key = columns[1] if name == "sql_window_frame" else columns[0]
    per_slice = sliced.groupBy(key, "slice").count()
    assert per_slice.agg(F.max("count")).first()[0] <= 3 * len(rows) / SLICES
    assert per_slice.groupBy(key).count().agg(F.max("count")).first()[0] <= SLICES
    return spark.sql(ACCEPTANCE[name][1])


@pytest.mark.parametrize("customer", [7, None])
@pytest.mark.parametrize("price", [50.0, None, NAN])
def test_rank_is_right_and_split(spark, customer, price):
    rows = [(i, customer, "O", price) for i in range(20000)]
    rows += [(20000 + i, customer, "O", x) for i, x in enumerate([NAN, 1.0, None, -3.5, 1e300, -1e300, math.inf])]
    rows += [(30000 + i, 8 + i, "O", 1.0) for i in range(50)]
    got = run_sliced(spark, "sql_window_rank", rows, ORDERS).collect()
    assert {r.o_orderkey: r.place for r in got} == ranks(rows)


def test_rank_of_distinct_prices_in_one_band(spark):
    rows = [(i, 7, "O", 50.0 + i / 1000) for i in range(20000)]
    got = run_sliced(spark, "sql_window_rank", rows, ORDERS).collect()
    assert {r.o_orderkey: r.place for r in got} == ranks(rows)


def frames(rows):
    """Sum of three and the value before, by hand; no time comes first."""
    out = {}
    for user in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == user), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        mine = [r for r in mine if r[2] is None] + [r for r in mine if r[2] is not None]
        for i, r in enumerate(mine):
            out[r[0]] = (round(sum(x[3] for x in mine[max(0, i - 2) : i + 1]), 4), mine[i - 1][3] if i else None)
    return out


@pytest.mark.parametrize("user", [7, None])
@pytest.mark.parametrize("when", [datetime.datetime(2024, 1, 1, 10, 0, 30), None])
def test_frame_is_right_and_split(spark, user, when):
    far = datetime.datetime(9999, 12, 31, 23, 59)
    rows = [(i, user, when, float(i % 13)) for i in range(20000)]
    rows += [(20000 + i, user, datetime.datetime(2024, 1, 1, 10, 0, i % 60), 2.0) for i in range(300)]
    rows += [(30000, user, far, 5.0), (30001, 1, far, 6.0), (30002, 1, None, 1.0)]
    got = run_sliced(spark, "sql_window_frame", rows, EVENTS).collect()
    assert {r.event_id: (r.sum3, r.previous) for r in got} == frames(rows)


def test_frame_of_distinct_times_in_one_minute(spark):
    start = datetime.datetime(2024, 1, 1, 10)
    rows = [(i, 7, start + datetime.timedelta(milliseconds=2 * i), float(i % 13)) for i in range(20000)]
    got = run_sliced(spark, "sql_window_frame", rows, EVENTS).collect()
    assert {r.event_id: (r.sum3, r.previous) for r in got} == frames(rows)


def test_frame_over_slices_of_one_or_no_event(spark):
    """What is lent may come from several slices before."""
    start = datetime.datetime(2024, 1, 1, 10)
    rows = [(i, 7, start + datetime.timedelta(seconds=i), float(i)) for i in range(9)] + [(99, 8, start, 1.0)]
    frame = spark.createDataFrame(rows, EVENTS)
    cut = frame.withColumn("slice", F.when(F.col("user_id") == 8, 99).otherwise(F.col("event_id") * 3).cast("int"))
    cut.createOrReplaceTempView("sliced_events")
    got = spark.sql(ACCEPTANCE["sql_window_frame"][1]).collect()
    assert {r.event_id: (r.sum3, r.previous) for r in got} == frames(rows)
