"""Parquet files as frames and as session-local names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or a whole folder of them, with the schema they carry."""
    return spark.read.parquet(path)


def parquet_view(spark: SparkSession, path: str, view: str) -> DataFrame:
    """The same, also readable in this session's SQL under the name ``view``."""
    frame = read_parquet(spark, path)
    frame.createOrReplaceTempView(view)
    return frame
