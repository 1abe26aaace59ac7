"""Sessions: stretches of a key's rows without a long pause between two of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from facetable.operators.ranges import SLICE, equal_keys, slice_by_range, spanning_keys

#: How partial sums of one kind become one.
MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}
FIRST = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def sessions(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    gap_seconds: float,
    measures: Mapping[str, tuple[str, str]] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """One row per session: the keys, ``session_start``, ``session_end`` (of the last row,
    without the gap), ``n_rows`` and ``measures``, a name for each (kind, column), where the kind
    is sum, min, max or count.

    A row belongs to the session of the row before it if less than the gap lies between.
    Slices find their sessions by themselves.  Only the first and last session of a slice may
    go on in another one; those of keys in several slices are put together at the end, two
    rows per slice at most.

    Edge cases: rows without a time are in no session; NULL is a key like others; rows at one
    time are in one session; an empty frame has none.  Keys may not be named like a result.
    """
    measures = dict(measures or {})
    unknown = {kind for kind, _ in measures.values()} - set(MERGE)
    if unknown:
        raise ValueError(f"no measure of kind {sorted(unknown)}")
    gap = F.expr(f"INTERVAL '{gap_seconds}' SECOND")
    inner = [f"k{n}" for n in range(len(keys))]
    rows = frame.where(F.col(f"`{time}`").isNotNull()).select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keys, inner, strict=True)],
        F.col(f"`{time}`").alias("t"),
        *[F.col(f"`{column}`").alias(f"m{n}") for n, (_, column) in enumerate(measures.values())],
    )
    # A random number tells rows at one time apart, so they too can be cut.
    sliced = slice_by_range(rows.withColumn("at_random", F.rand(7)), [*inner, "t", "at_random"], slices)

    def numbered(part: DataFrame, by: list[str], start: str, end: str, name: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(start, end)
        before = F.lag(end).over(order)
        new = (before.isNull() | (F.col(start) >= before + gap)).cast("long")
        return part.withColumn("new", new).withColumn(
            name, F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
        ).drop("new")

    def merged(part: DataFrame, by: list[str], kinds: Mapping, start: str, end: str, count: Column) -> DataFrame:
        return part.groupBy(*by).agg(
            F.min(start).alias("session_start"),
            F.max(end).alias("session_end"),
            count.alias("n_rows"),
            *[kinds[kind](f"m{n}").alias(f"m{n}") for n, (kind, _) in enumerate(measures.values())],
        )

    slice_key = [*inner, SLICE]
    local = merged(numbered(sliced, slice_key, "t", "t", "number"), [*slice_key, "number"], FIRST, "t", "t", F.count("*"))
    local = local.withColumn("last", F.max("number").over(Window.partitionBy(*slice_key)))
    spans = spanning_keys(sliced, inner).withColumn("spans", F.lit(True))
    marked = local.alias("s").join(F.broadcast(spans).alias("b"), equal_keys("s", "b", inner), "left")
    at_edge = F.col("spans").isNotNull() & ((F.col("number") == 1) | (F.col("number") == F.col("last")))
    marked = marked.select("s.*", F.coalesce(at_edge, F.lit(False)).alias("at_edge"))
    columns = [*inner, "session_start", "session_end", "n_rows", *[f"m{n}" for n in range(len(measures))]]
    edges = numbered(marked.where("at_edge").select(*columns), inner, "session_start", "session_end", "whole")
    joined = merged(edges, [*inner, "whole"], MERGE, "session_start", "session_end", F.sum("n_rows"))
    out = marked.where("NOT at_edge").select(*columns).unionByName(joined.select(*columns))
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(keys, inner, strict=True)],
        "session_start",
        "session_end",
        "n_rows",
        *[F.col(f"m{n}").alias(name) for n, name in enumerate(measures)],
    )
