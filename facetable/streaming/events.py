"""Rows as messages, messages as rows, and the writer between them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from facetable.functions.envelope import (
    NO_KEY,
    parse_json,
    parse_text,
    payload_text,
    row_json,
    row_text,
)
from facetable.functions.names import quote

# Fixed value: how often a micro-batch starts unless the caller says otherwise.
TRIGGER = {"processingTime": "1 second"}


def to_events(frame: DataFrame, form: str = "text", key: str | None = None) -> DataFrame:
    """One message per row: binary ``data`` and binary ``key``.

    ``form="text"`` joins the columns by commas; ``form="json"`` keeps everything
    needed to rebuild the row.  The key is one constant for all rows unless a
    column is named; brokers that spread messages by key need one.  Works on
    batch and streaming frames alike.
    """
    if form not in ("text", "json"):
        raise ValueError("form must be 'text' or 'json'")
    data = row_text() if form == "text" else row_json()
    label = F.lit(NO_KEY) if key is None else F.col(quote(key)).cast("string")
    return frame.select(data.cast("binary").alias("data"), label.cast("binary").alias("key"))


def from_events(
    events: DataFrame,
    schema: T.StructType | None = None,
    form: str = "text",
    with_key: bool = False,
) -> DataFrame:
    """What a consumer reads: the text of each message, or the row it came from.

    With a schema the message is parsed and a message that does not fit raises.
    ``with_key`` adds the key of the message as text, in a last column ``key``; a row
    that has a column of that name cannot be asked for it.
    """
    text = payload_text(F.col("data"))
    keys = [payload_text(F.col("key")).alias("key")] if with_key else []
    if schema is None:
        return events.select(text.alias("text"), *keys)
    if with_key and "key" in (name.lower() for name in schema.names):
        raise ValueError("the row has a column named key of its own")
    parse = {"text": parse_text, "json": parse_json}[form]
    return events.select(parse(text, schema).alias("row"), *keys).select(
        "row.*", *(["key"] if with_key else [])
    )


def write_events(
    events: DataFrame,
    checkpoint: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start sending messages to a sink; the caller gets the running query.

    The same checkpoint resumes after the last finished batch, a new one sends
    everything again.  Keep it in a folder that outlives the machine.
    """
    writer = events.writeStream.format(fmt).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).options(**(options or {}))
    return writer.trigger(**(trigger or TRIGGER)).start()


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Wait so long, then stop the query.  True when it had ended by itself."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)
