"""Streaming scans that start at a point in time."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark forgets files it has seen, and passes over new ones, that are this much older
# than the latest.  Its week would drop late files without a word; a century drops none.
KEPT_AGE = "36500d"

# How many files one micro-batch reads unless the caller says otherwise: a replay
# of a large table then goes on from its last batch after a failure.  One listing
# of the folder serves a hundred such batches.
BATCH_FILES = 1000
LISTED_FILES = 100 * BATCH_FILES


def start_from_offset(offset_ms: int) -> int:
    """Epoch milliseconds of now plus the offset: 0 is new rows, below 0 a replay."""
    return int(time.time() * 1000) + int(offset_ms)


def fixed_start(spark: SparkSession, checkpoint: str, offset_ms: int) -> int:
    """The start of the first run with this checkpoint, for all later runs too.

    A start worked out anew at a restart lies after the rows that came in while
    the stream was down, and they would be lost.  The first run writes its start
    beside the checkpoint; the next ones read it.
    """
    path = f"{checkpoint.rstrip('/')}.start"
    one_row = spark.range(0, 1, 1, numPartitions=1)
    start = one_row.select(F.lit(start_from_offset(offset_ms)).alias("start_ms"))
    start.write.mode("ignore").parquet(path)
    kept = _kept_start(spark, path)
    if kept is None:
        # The folder is there, but the run that made it ended before writing.
        start.write.mode("overwrite").parquet(path)
        kept = _kept_start(spark, path)
    return kept


def read_changes(
    spark: SparkSession,
    table_name: str,
    start_ms: int,
    provider: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows added to a table at or after ``start_ms``, as a stream.

    Without a provider the table is one of Spark's own, made of files, and the
    time is that of the file; files before the start are skipped, not read.  A
    file is older than the commit that shows it, so set the start back by as long
    as the longest load takes.  With a long history and a late start,
    ``{"latestFirst": "true"}`` brings the new rows before the history has been
    skipped.  Such a table must only grow: replacing it sends all its rows again.
    A table format with snapshots (``provider="iceberg"``) goes by the time of
    the commit and is asked by its own option.
    """
    if provider is not None:
        reader = spark.readStream.format(provider).options(**(options or {}))
        return reader.option("stream-from-timestamp", str(start_ms)).load(table_name)
    reader = spark.readStream.options(**_bounded(options))
    return _from_start(reader.table(table_name), start_ms)


def read_file_changes(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    start_ms: int,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of files added to a folder at or after ``start_ms``, as a stream.

    The folder may be a path pattern.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**_bounded(options))
    return _from_start(reader.load(folder), start_ms)


def _bounded(options: Mapping[str, str] | None) -> dict[str, str]:
    """The options, with a bound on the micro-batch and without one on the age of files.

    Both stay as the caller sets them.  The list of files seen, kept with the
    checkpoint, then grows with the number of files.
    """
    options = dict(options or {})
    if "maxfileage" not in {name.lower() for name in options}:
        options["maxFileAge"] = KEPT_AGE
    bounds = {"maxfilespertrigger", "maxbytespertrigger"}
    if not bounds & {name.lower() for name in options}:
        options["maxFilesPerTrigger"] = str(BATCH_FILES)
        options["maxCachedFiles"] = str(LISTED_FILES)
    return options


def _from_start(stream: DataFrame, start_ms: int) -> DataFrame:
    added = F.col("_metadata.file_modification_time")
    return stream.where(added >= F.timestamp_millis(F.lit(start_ms)))


def _kept_start(spark: SparkSession, path: str) -> int | None:
    row = spark.read.schema("start_ms long").parquet(path).first()
    return None if row is None else row.start_ms
