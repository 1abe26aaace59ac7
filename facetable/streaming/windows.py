"""Event-time work on streams: windows, sessions, first sightings and interval joins.

All take a stream and say how late a row may be; rows later than the watermark are left
out and counted (``late_rows``).  State is kept by key, and dropped once the watermark has
passed it, so it is bounded by the delay and not by the length of the stream.  A window or
session is sent once, when the watermark has passed its end (append mode); what is open
when a stream stops is kept with the checkpoint and sent by the next run.

Hot keys: totals of windows are summed in every task before the shuffle.  Sessions are too,
where ``spark.sql.sessionWindow.merge.sessions.in.local.partition`` is on.

Times without a zone are taken as times of the session's zone; the results have the kind
of time that went in.  A row without a time is in no window, and in no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_TIME = "event_time"


def _timed(stream: DataFrame, time: str, delay: str, name: str = _TIME) -> DataFrame:
    """With a column of event time that a watermark can follow."""
    if name in (c.lower() for c in stream.columns):
        raise ValueError(f"there is a column named {name} already")
    return stream.withColumn(name, F.col(f"`{time}`").cast("timestamp")).withWatermark(name, delay)


def _kind(stream: DataFrame, time: str) -> str:
    return stream.schema[time].dataType.simpleString()


def window_totals(
    stream: DataFrame,
    time: str,
    width: str,
    totals: Sequence[Column],
    keys: Sequence[str] = (),
    delay: str = "0 seconds",
    slide: str | None = None,
) -> DataFrame:
    """``window_start``, ``window_end``, the keys and ``totals`` of each window of time.

    ``slide`` makes windows overlap; a row then counts in several.
    """
    kind = _kind(stream, time)
    window = F.window(_TIME, width, slide) if slide else F.window(_TIME, width)
    grouped = _timed(stream, time, delay).groupBy(window.alias("w"), *[F.col(f"`{k}`") for k in keys]).agg(*totals)
    return grouped.select(
        F.col("w.start").cast(kind).alias("window_start"), F.col("w.end").cast(kind).alias("window_end"),
        *grouped.columns[1:],
    )


def session_totals(
    stream: DataFrame,
    time: str,
    gap: str,
    totals: Sequence[Column],
    keys: Sequence[str],
    delay: str = "0 seconds",
) -> DataFrame:
    """``session_start``, ``session_end`` (of its last row), the keys and ``totals``.

    A row belongs to a session if less than the gap lies between them; one that comes
    late, but in time, may join two sessions into one.
    """
    kind = _kind(stream, time)
    window = F.session_window(_TIME, gap).alias("w")
    grouped = _timed(stream, time, delay).groupBy(window, *[F.col(f"`{k}`") for k in keys]).agg(*totals)
    return grouped.select(
        F.col("w.start").cast(kind).alias("session_start"),
        (F.col("w.end") - F.expr(f"INTERVAL {gap}")).cast(kind).alias("session_end"),
        *grouped.columns[1:],
    )


def first_seen(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Each row whose keys have not been seen within the delay: a message that is sent again
    does not pass twice."""
    return _timed(stream, time, delay).dropDuplicatesWithinWatermark(list(keys)).drop(_TIME)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    earliest: str,
    latest: str,
    delay: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs of rows with equal keys where the right one is at most ``earliest`` before and
    ``latest`` after the left one.  Keys and other columns of ``right`` must have names of
    their own: ``on`` has pairs (left, right).

    With ``how="left"`` a left row without a partner is sent once the watermark says that
    none can come.  Both sides are kept for as long as a partner may arrive.
    """
    timed_left = _timed(left, left_time, delay, "left_time")
    timed_right = _timed(right, right_time, delay, "right_time")
    condition = F.expr(
        f"right_time >= left_time - INTERVAL {earliest} AND right_time <= left_time + INTERVAL {latest}"
    )
    for mine, theirs in on:
        condition &= F.col(f"`{mine}`") == F.col(f"`{theirs}`")
    return timed_left.join(timed_right, condition, how).drop("left_time", "right_time")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the recent batches of a query left out because they came too late."""
    return sum(
        state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"]
    )
