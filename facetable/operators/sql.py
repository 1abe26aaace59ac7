"""Any one Spark SQL statement."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(
    spark: SparkSession, text: str, args: Mapping[str, Any] | None = None
) -> DataFrame:
    """The result of one statement, as a frame.

    Values go in by name: ``run_sql(spark, "... WHERE a > :low", {"low": 5})``.
    Queries stay lazy; DDL and DML take effect at once, as always in Spark.  The
    session is left running.
    """
    return spark.sql(text, args=dict(args) if args else None)
