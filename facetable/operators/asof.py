"""As-of join: each row meets the latest row of the other side that came before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from facetable.operators.ranges import SLICE, carried, equal_keys, slice_by_range


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    take: Sequence[str],
    ties: Sequence[str] = (),
    same_time: bool = True,
    slices: int | None = None,
) -> DataFrame:
    """All rows of ``left``, with the columns ``take`` of the latest row of ``right`` that has
    the same keys and a time before theirs (or the same, with ``same_time``).

    Of rows at one time the one with the largest ``ties`` counts; without them, any.  Both
    sides are sorted into one order and cut into slices; a slice looks back within itself,
    and starts from the last right row of the slices before.  No pairs are listed.

    Edge cases: a row of ``left`` whose key or time is NULL, or that nothing precedes, has
    NULLs; rows of ``right`` without key or time match nothing; repeated left rows all stay;
    columns of ``left`` that are named like one of ``take`` raise.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in take}
    if clash:
        raise ValueError(f"both sides have the columns {sorted(clash)}")
    keys = [f"k{n}" for n in range(len(on))]

    def rows(frame: DataFrame, time: str, is_left: bool) -> DataFrame:
        own = F.struct(*[F.col(f"`{c}`") for c in (frame.columns if is_left else take)])
        none = F.lit(None)
        order = [F.col(f"`{c}`") for c in ties] if not is_left else [none.cast(right.schema[c].dataType) for c in ties]
        return frame.select(
            *[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys, strict=True)],
            F.col(f"`{time}`").alias("t"),
            F.lit(is_left == same_time).alias("late"),  # what comes second at one time
            *[o.alias(f"o{n}") for n, o in enumerate(order)],
            F.lit(is_left).alias("is_left"),
            (own if is_left else none).alias("l"),
            (none if is_left else own).alias("r"),
        )

    known = [F.col(f"`{c}`").isNotNull() for c in (*on, right_time)]
    latest = right
    for condition in known:
        latest = latest.where(condition)
    order: list[str | Column] = [*keys, "t", "late", *[f"o{n}" for n in range(len(ties))]]
    left_rows, right_rows = rows(left, left_time, True), rows(latest, right_time, False)
    # Fill the typed NULLs of each side from the other's schema.
    both = left_rows.withColumn("r", F.col("r").cast(right_rows.schema["r"].dataType)).unionByName(
        right_rows.withColumn("l", F.col("l").cast(left_rows.schema["l"].dataType))
    )
    sliced = slice_by_range(both, order, slices)
    here = Window.partitionBy(*keys, SLICE).orderBy(*order[len(keys) :]).rowsBetween(Window.unboundedPreceding, 0)
    seen = sliced.withColumn("found", F.last("r", ignorenulls=True).over(here)).where("is_left")
    place = F.struct("t", *[f"o{n}" for n in range(len(ties))])
    last = sliced.groupBy(*keys, SLICE).agg(
        F.max_by("r", F.when(~F.col("is_left"), place)).alias("r")
    )
    before = carried(last, keys, "r")
    joined = seen.alias("s").join(
        F.broadcast(before).alias("b"), equal_keys("s", "b", keys) & (F.col(f"s.{SLICE}") == F.col(f"b.{SLICE}")), "left"
    )
    usable = F.col("s.t").isNotNull()
    for k in keys:
        usable &= F.col(f"s.{k}").isNotNull()
    found = F.when(usable, F.coalesce("s.found", "b.r"))
    return joined.select("s.l", found.alias("r")).select("l.*", *[F.col(f"r.`{c}`") for c in take])
