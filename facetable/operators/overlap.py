"""Interval-overlap join: pairs of rows whose stretches of time have a moment in common."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of one size that a stretch covers at most, and how much larger the next size is.
COVERED = 8
STEP = 8
#: Sizes of buckets: the largest is ``STEP ** (SIZES - 1)`` times the smallest.
SIZES = 10


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    smallest_seconds: int,
    on: Sequence[tuple[str, str]] = (),
    n_sizes: int = SIZES,
) -> DataFrame:
    """All pairs of rows with left_start <= right_end and right_start <= left_end, both ends
    included, and equal keys (``on`` has pairs of names).  All column names must differ.

    Time is cut into buckets of several sizes, from ``smallest_seconds`` up by ``STEP``.  A
    stretch is put into the buckets of the smallest size of which it covers ``COVERED`` or
    fewer, so a long one is a few rows, not thousands.  Stretches of two sizes meet in the
    buckets of the larger size: the smaller-sized one is put there as a guest, into two at
    most.  Guests meet those at home in a bucket, never each other.
    Every pair is emitted in the bucket that holds the later of the two starts, and in no
    other, so none is listed twice and no duplicates need be removed.

    What is shuffled is a bounded number of rows per row, the fewer the fewer sizes there are;
    pairs are formed only in a bucket.  Stretches of more than ``COVERED`` of the largest
    buckets are right, but more rows.
    Edge cases: rows with a NULL time or key, or an end before its start, have no partner;
    repeated rows pair repeatedly; a stretch of one moment counts.  Empty tables give none.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have the columns {sorted(clash)}")
    sizes = F.array(*[F.lit(smallest_seconds * STEP**n).cast("long") for n in range(n_sizes)])

    def seconds(column: str) -> Column:
        return F.unix_micros(F.col(f"`{column}`").cast("timestamp"))

    def dealt(frame: DataFrame, span: tuple[str, str], name: str, keys: list[str]) -> DataFrame:
        start, end = map(seconds, span)
        bounded = frame.select(
            F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias(name),
            *[F.col(f"`{c}`").alias(f"{name}k{n}") for n, c in enumerate(keys)],
            start.alias(f"{name}s"),
            end.alias(f"{name}e"),
        ).where(F.col(f"{name}s") <= F.col(f"{name}e"))
        length = F.col(f"{name}e") - F.col(f"{name}s")
        # The size of a stretch: the first whose bucket is not shorter than an eighth of it.
        fits = F.filter(F.sequence(F.lit(0), F.lit(n_sizes - 1)), lambda n: F.get(sizes, n) * (COVERED * 1_000_000) >= length)
        return bounded.withColumn(f"{name}size", F.coalesce(F.array_min(fits), F.lit(n_sizes - 1)))

    def in_buckets(frame: DataFrame, name: str, own: str, guest: str) -> DataFrame:
        """A row per bucket and part: of the own size, and as a guest of all larger ones."""
        each = frame.withColumn("size", F.explode(F.sequence(F.col(f"{name}size"), F.lit(n_sizes - 1))))
        width = F.get(sizes, F.col("size")) * 1_000_000
        first, last = F.floor(F.col(f"{name}s") / width), F.floor(F.col(f"{name}e") / width)
        at_home = F.col("size") == F.col(f"{name}size")
        parts = F.when(at_home, F.array(F.lit("both"), F.lit(own))).otherwise(F.array(F.lit(guest)))
        return each.withColumn("bucket", F.explode(F.sequence(first, last))).withColumn("part", F.explode(parts))

    # Who is at home: both, the left one or the right one.
    a = in_buckets(dealt(left, left_span, "l", [mine for mine, _ in on]), "l", "left", "right")
    b = in_buckets(dealt(right, right_span, "r", [theirs for _, theirs in on]), "r", "right", "left")
    width = F.get(sizes, F.col("a.size")) * 1_000_000
    meet = [
        F.col("a.size") == F.col("b.size"),
        F.col("a.bucket") == F.col("b.bucket"),
        F.col("a.part") == F.col("b.part"),
        F.col("a.ls") <= F.col("b.re"),
        F.col("b.rs") <= F.col("a.le"),
        F.floor(F.greatest("a.ls", "b.rs") / width) == F.col("a.bucket"),
        *[F.col(f"a.lk{n}") == F.col(f"b.rk{n}") for n in range(len(on))],
    ]
    return a.alias("a").join(b.alias("b"), reduce(Column.__and__, meet)).select("l.*", "r.*")
