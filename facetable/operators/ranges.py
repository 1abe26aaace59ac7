"""Ordered work on keys of any size: rows in slices of a total order.

A window over a key gathers the key in one task.  Here rows are first sorted into ranges
of about equal size by (key, order), so a key with a third of all rows has many slices,
and every other one or two.  A slice is worked on by itself; what it must know of the
slices before it, of which there are few, is found from one row per key and slice.

The slices are written to the shared folder: bounds are drawn from samples, and everything
that is computed from them must see the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from facetable.session import scratch_path

SLICE = "slice"


def slice_by_range(frame: DataFrame, order: Sequence[str | Column], slices: int | None = None) -> DataFrame:
    """``frame`` with ``slice``: the number of the range of ``order`` that a row is in.

    Rows are cut at any place of the order but between equal ones, so end it by a column
    that tells rows apart.  Without a number Spark chooses slices by size.
    """
    if SLICE in (name.lower() for name in frame.columns):
        raise ValueError(f"there is a column named {SLICE} already")
    ranged = frame.repartitionByRange(slices, *order) if slices else frame.repartitionByRange(*order)
    path = scratch_path(frame.sparkSession, "slices")
    numbered = ranged.withColumn(SLICE, F.spark_partition_id())
    numbered.write.parquet(path)
    return frame.sparkSession.read.schema(numbered.schema).parquet(path)


def equal_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """The condition that two aliased frames have the same keys, NULL among them."""
    return reduce(Column.__and__, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def carried(state: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The last value of the slices before, for the slices that continue a key.

    ``state`` has one row per key and slice.  The answer has one row per slice at most,
    as only one key reaches into a slice from the one before.
    """
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(value, ignorenulls=True).over(before).alias(value)
    return state.select(*keys, SLICE, found).where(F.col(value).isNotNull())


def spanning_keys(sliced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys in more than one slice: fewer than there are slices."""
    return sliced.groupBy(*keys).agg(F.min(SLICE).alias("lo"), F.max(SLICE).alias("hi")).where("lo < hi").select(*keys)
