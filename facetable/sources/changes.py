"""Upsert, update and delete on a partitioned table: touched partitions are written anew.

A change is made in two steps.  The new content of the touched partitions is written to a
folder beside the table's journal, and a list of these partitions after it; then the
table's partitions are overwritten from there.  A job that ends before the list is there
has changed nothing.  One that ends later has changed some partitions: the next change, or
``finish_changes``, overwrites all of them again from the same files, which has the same
result however often it is done.  One change at a time may run on a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetable.functions.names import quote


def upsert(rows: DataFrame, table_name: str, keys: Sequence[str], journal: str) -> None:
    """Put ``rows`` into the table, in the place of its rows with the same keys.

    A key that several rows have is refused, as either could be meant; so is a NULL in a
    key.  A row may move to another partition.  Columns are found by name.
    """
    spark = rows.sparkSession
    finish_changes(spark, table_name, journal)
    old, parts = spark.table(table_name), partition_columns(spark, table_name)
    names = [F.col(quote(k)) for k in keys]
    wrong = rows.groupBy(*names).count().where(
        (F.col("count") > 1) | reduce(Column.__or__, [k.isNull() for k in names])
    )
    if not wrong.isEmpty():
        raise ValueError(f"keys {list(keys)} must be known and different in every row")
    fresh = rows.select(*[F.col(quote(c)) for c in old.columns])
    hit = old.join(fresh.select(*names), list(keys), "left_semi").select(*map(quote, parts))
    touched = hit.union(fresh.select(*map(quote, parts))).distinct()
    kept = _within(old, touched, parts).join(fresh.select(*names), list(keys), "left_anti").select(*map(quote, old.columns))
    _change(spark, table_name, kept.unionByName(fresh), touched, journal)


def delete_rows(spark: SparkSession, table_name: str, condition: str, journal: str) -> None:
    """Delete the rows for which ``condition`` is true; where it is NULL they stay."""
    finish_changes(spark, table_name, journal)
    old, parts = spark.table(table_name), partition_columns(spark, table_name)
    touched = old.where(condition).select(*map(quote, parts)).distinct()
    kept = _within(old, touched, parts).where(~F.coalesce(F.expr(condition), F.lit(False)))
    _change(spark, table_name, kept, touched, journal)


def update_rows(
    spark: SparkSession, table_name: str, values: Mapping[str, str], condition: str, journal: str
) -> None:
    """Set columns to SQL expressions of the row as it was, where ``condition`` is true.

    Columns of partitions cannot be set; delete and upsert do that.
    """
    finish_changes(spark, table_name, journal)
    old, parts = spark.table(table_name), partition_columns(spark, table_name)
    unknown = set(values) - set(old.columns)
    if unknown or set(values) & set(parts):
        raise ValueError(f"cannot set {sorted(unknown | (set(values) & set(parts)))}")
    touched = old.where(condition).select(*map(quote, parts)).distinct()
    chosen = F.coalesce(F.expr(condition), F.lit(False))
    changed = _within(old, touched, parts).select(
        *[
            F.when(chosen, F.expr(values[c]).cast(old.schema[c].dataType)).otherwise(F.col(quote(c))).alias(c)
            if c in values
            else F.col(quote(c))
            for c in old.columns
        ]
    )
    _change(spark, table_name, changed, touched, journal)


def finish_changes(spark: SparkSession, table_name: str, journal: str) -> int:
    """Finish what a job that ended half-way has begun; how many changes there were."""
    folder = _journal(spark, table_name, journal)
    done = 0
    for path in _folders(spark, folder):
        if _exists(spark, f"{path}/touched/_SUCCESS") and not _exists(spark, f"{path}/done"):
            _publish(spark, table_name, path)
            done += 1
    return done


def partition_columns(spark: SparkSession, table_name: str) -> list[str]:
    """The columns a table is partitioned by; a table without any is refused."""
    parts = [c.name for c in spark.catalog.listColumns(table_name) if c.isPartition]
    if not parts:
        raise ValueError(f"{table_name} has no partitions, a change would write all of it anew")
    return parts


def _within(old: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The rows of the touched partitions; files of others are not read."""
    same = [F.col(f"o.{quote(p)}").eqNullSafe(F.col(f"t.{quote(p)}")) for p in parts]
    return old.alias("o").join(touched.alias("t"), reduce(Column.__and__, same), "left_semi")


def _change(spark: SparkSession, table_name: str, content: DataFrame, touched: DataFrame, journal: str) -> None:
    path = f"{_journal(spark, table_name, journal)}/{uuid.uuid4().hex}"
    content.write.parquet(f"{path}/rows")
    touched.write.parquet(f"{path}/touched")  # from here on the change will be finished
    _publish(spark, table_name, path)


def _publish(spark: SparkSession, table_name: str, path: str) -> None:
    parts = partition_columns(spark, table_name)
    rows = spark.read.schema(spark.table(table_name).schema).parquet(f"{path}/rows")
    _overwrite_partitions(rows, table_name)
    touched = spark.read.parquet(f"{path}/touched")
    filled = rows.select(*map(quote, parts)).distinct()
    same = [F.col(f"a.{quote(p)}").eqNullSafe(F.col(f"b.{quote(p)}")) for p in parts]
    empty = touched.alias("a").join(filled.alias("b"), reduce(Column.__and__, same), "left_anti")
    for row in empty.collect():  # names of partitions, not rows
        given = {f"v{n}": v for n, v in enumerate(row) if v is not None}
        spec = ", ".join(f"{quote(p)} = " + (f":v{n}" if row[n] is not None else "NULL") for n, p in enumerate(parts))
        spark.sql(f"ALTER TABLE {table_name} DROP IF EXISTS PARTITION ({spec})", args=given)
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/done")


def _overwrite_partitions(rows: DataFrame, table_name: str) -> None:
    """Replace the partitions that ``rows`` has, and no others."""
    conf, setting = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(setting)
    conf.set(setting, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table_name)
    finally:
        conf.set(setting, before)


def _journal(spark: SparkSession, table_name: str, journal: str) -> str:
    full = table_name if "." in table_name else f"{spark.catalog.currentDatabase()}.{table_name}"
    return f"{journal.rstrip('/')}/{full.replace('`', '')}"


def _files(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path, files = _files(spark, path)
    return files.exists(jvm_path)


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm_path, files = _files(spark, path)
    return [f.getPath().toString() for f in files.listStatus(jvm_path)] if files.exists(jvm_path) else []
