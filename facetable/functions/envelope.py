"""Message payloads: one row as text, and the text as a row again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Separator and key of the default message.
SEPARATOR = ","
NO_KEY = "NOKEY"

# Spark writes three digits of a second in CSV and JSON unless told otherwise, and
# cuts the seconds off a zone's offset, which many had before 1900.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_text() -> Column:
    """All columns of the frame, joined by commas.

    Nothing is quoted and NULL leaves no trace, so ``(3, 4, NULL)`` reads
    ``3,4``.  Use :func:`row_json` where the row must be rebuilt exactly.
    """
    return F.concat_ws(SEPARATOR, F.col("*"))


def row_json() -> Column:
    """All columns as one JSON object that keeps NULL, ``''`` and commas apart."""
    return F.to_json(F.struct("*"), {**MICROSECONDS, "ignoreNullFields": "false"})


def payload_text(data: Column) -> Column:
    """Message bytes as text."""
    return F.decode(data, "UTF-8")


def parse_text(text: Column, schema: T.StructType) -> Column:
    """Comma text as a struct.

    Exact only for rows without NULL and ``''`` and for values without commas and
    line breaks; the text does not tell those apart.
    """
    # The text was not written by a CSV writer: quotes are plain characters.
    options = {"sep": SEPARATOR, "quote": "", "mode": "FAILFAST"}
    return F.from_csv(text, schema.toDDL(), options)


def parse_json(text: Column, schema: T.StructType) -> Column:
    """JSON text as a struct."""
    return F.from_json(text, schema, {**MICROSECONDS, "mode": "FAILFAST"})
