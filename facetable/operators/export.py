"""Writing a frame out: CSV folders and staged copies for another store."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetable.functions.envelope import MICROSECONDS
from facetable.functions.names import flat_name, quote, staged_name

# Spark's own file formats are saved by path; anything else is a connector that
# takes the target as an option.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "xml")

# Options that bring every value back when used for both writing and reading:
# quotes are doubled, outer blanks and microseconds are kept, NULL is told from '',
# and the end of a line is not guessed, which would turn \r inside a text into \n.
# NULL is written as \N, the one text that reads back as something else.
LOSSLESS_CSV = {
    **MICROSECONDS,
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
    "lineSep": "\n",
    "multiLine": "true",
}

NESTED = (T.ArrayType, T.MapType, T.StructType)


def export_csv(
    frame: DataFrame,
    directory: str,
    table_name: str,
    options: Mapping[str, str] | None = None,
    nested: str = "error",
) -> str:
    """Write all rows to ``directory/table_name``, replacing what is there.

    No header and default CSV options unless ``options`` says otherwise.  Every
    task writes its own file, so the export keeps the parallelism of the scan;
    ``maxRecordsPerFile`` bounds the files.  CSV has no nested values: they raise,
    or become JSON text with ``nested="json"``.
    """
    if nested not in ("error", "json"):
        raise ValueError("nested must be 'error' or 'json'")
    if nested == "json":
        frame = _flatten(frame)
    target = f"{directory.rstrip('/')}/{table_name}"
    frame.write.format("csv").mode("overwrite").options(**(options or {})).save(target)
    return target


def export_table(
    frame: DataFrame,
    dataset: str,
    table_name: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    name_option: str = "table",
) -> str:
    """Stage a copy of the frame as ``table_name`` of ``dataset``; returns the target.

    File formats write the folder ``dataset/db_table``.  A warehouse connector
    gets ``dataset.db_table`` in the option it reads the name from
    (``name_option``).  An earlier copy is replaced.
    """
    writer = frame.write.format(fmt).mode("overwrite").options(**(options or {}))
    if fmt in FILE_FORMATS:
        target = f"{dataset.rstrip('/')}/{flat_name(table_name)}"
        writer.save(target)
    else:
        target = staged_name(dataset, table_name)
        writer.option(name_option, target).save()
    return target


def read_staged(
    spark: SparkSession,
    target: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    name_option: str = "table",
    schema: T.StructType | None = None,
) -> DataFrame:
    """The staged copy that :func:`export_table` returned ``target`` for.

    ``schema`` saves text formats a pass over the data to guess one.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt in FILE_FORMATS:
        return (reader if schema is None else reader.schema(schema)).load(target)
    return reader.option(name_option, target).load()


def _flatten(frame: DataFrame) -> DataFrame:
    columns = []
    for field in frame.schema:
        column = F.col(quote(field.name))
        if isinstance(field.dataType, NESTED):
            column = F.to_json(column, {**MICROSECONDS, "ignoreNullFields": "false"})
        elif isinstance(field.dataType, T.NullType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return frame.select(*columns)
