"""Tables by name: create, scan, list, get."""

from __future__ import annotations

import re
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetable.functions.names import quote
from facetable.sources.files import read_parquet

LISTING = "database string, `table` string, full_name string"


class TableNotFound(LookupError):
    """The catalog holds no table of that name."""


def create_table_from_parquet(
    spark: SparkSession, path: str, table_name: str, provider: str = "parquet"
) -> DataFrame:
    """Create or fully replace ``table_name`` with the Parquet data at ``path``."""
    _refuse_own_location(spark, path, table_name)
    return create_table(read_parquet(spark, path), table_name, provider)


def create_table(frame: DataFrame, table_name: str, provider: str = "parquet") -> DataFrame:
    """Create or fully replace a table with the rows and schema of ``frame``.

    Every task writes the split it read, so nothing is shuffled.  A catalog
    plug-in (Iceberg, for one) replaces the table in one step.  In the built-in
    catalog the new rows are written to a table of another name first, which then
    takes the place of the old one: a job that fails leaves the old table as it was, and
    a frame may read the table it replaces.  Between the two renames there is no table of
    the name for a moment; the old one is dropped last.
    """
    spark = frame.sparkSession
    if _has_plugin(spark, table_name):
        frame.writeTo(table_name).using(provider).createOrReplace()
    elif spark.catalog.tableExists(table_name):
        _replace(frame, table_name, provider)
    else:
        frame.write.format(provider).saveAsTable(table_name)
    return scan_table(spark, table_name)


def _replace(frame: DataFrame, table_name: str, provider: str) -> None:
    spark, mark = frame.sparkSession, uuid.uuid4().hex
    *path, name = _parts(table_name)
    new, old = (".".join(map(quote, [*path, f"{name}_{label}_{mark}"])) for label in ("new", "old"))
    own = ".".join(map(quote, [*path, name]))
    try:
        frame.write.format(provider).saveAsTable(new)
        spark.sql(f"ALTER TABLE {own} RENAME TO {old}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"ALTER TABLE {new} RENAME TO {own}")
    spark.sql(f"DROP TABLE {old}")


def _parts(table_name: str) -> list[str]:
    """The parts of a name, without quotes."""
    found = re.findall(r"`(?:[^`]|``)*`|[^.`]+", table_name)
    return [p[1:-1].replace("``", "`") if p.startswith("`") else p for p in found]


def scan_table(spark: SparkSession, table_name: str) -> DataFrame:
    """All rows and columns of a table."""
    return spark.table(table_name)


def list_tables(spark: SparkSession) -> DataFrame:
    """Every table of every database as (database, table, full_name).

    The listing is read from the catalog on each call.  Views of the session are
    left out.  Only names pass through the driver, and one task is enough for them.
    """
    rows = []
    for (database,) in spark.sql("SHOW DATABASES").collect():
        # Spark has quoted the name already where it needs it.
        listed = spark.sql(f"SHOW TABLES IN {database}")
        for entry in listed.where(~F.col("isTemporary")).collect():
            rows.append((database, entry.tableName, f"{database}.{entry.tableName}"))
    return spark.createDataFrame(rows, LISTING).coalesce(1)


def get_table(spark: SparkSession, table_name: str) -> DataFrame:
    """A catalog table as a frame; raises :class:`TableNotFound` when there is none."""
    return scan_table(spark, find_table(spark, table_name))


def find_table(spark: SparkSession, table_name: str) -> str:
    """The name with its database.  Views of the session do not count as tables."""
    full_name = table_name
    if "." not in table_name:
        full_name = f"{spark.catalog.currentDatabase()}.{table_name}"
    if not spark.catalog.tableExists(full_name):
        raise TableNotFound(f"no table {full_name} in the catalog")
    return full_name


def _has_plugin(spark: SparkSession, table_name: str) -> bool:
    first = table_name.split(".")[0]
    named = spark.conf.get(f"spark.sql.catalog.{first}", None)
    if named is not None:
        return named != "builtin"
    current = spark.catalog.currentCatalog()
    return spark.conf.get(f"spark.sql.catalog.{current}", "builtin") != "builtin"


def _refuse_own_location(spark: SparkSession, path: str, table_name: str) -> None:
    """Replacing a table from its own files would drop them before they are read."""
    if _has_plugin(spark, table_name) or not spark.catalog.tableExists(table_name):
        return
    details = spark.sql(
        "DESCRIBE TABLE EXTENDED IDENTIFIER(:table)", args={"table": table_name}
    )
    for (location,) in (
        details.where("col_name = 'Location'").select("data_type").collect()
    ):
        if _overlap(location, path):
            raise ValueError(f"{table_name} is kept in {location} and cannot be made from it")


def _overlap(location: str, path: str) -> bool:
    """Whether one path is the other or lies within it; a missing host fits any."""
    kept, read = urlparse(location), urlparse(path)
    if kept.netloc and read.netloc and kept.netloc != read.netloc:
        return False
    inner, outer = (url.path.rstrip("/") + "/" for url in (kept, read))
    return inner.startswith(outer) or outer.startswith(inner)
