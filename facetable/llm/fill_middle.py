"""Fill-in-middle: texts are cut into prefix, middle and suffix, and their parts moved.

Tokens are runs of ASCII letters and single other characters.  A hash of a seed and the
id draws the two cuts and the form:

* ``plain``: the text as it is;
* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

A text becomes one bytearray with the sentinels put in where the parts are, and two
neighbouring blocks of it are exchanged in place by three reversals: of each block, and
of both together.  Restoring finds the sentinels, exchanges the blocks back by the same
rotation and takes the sentinels out.  Places are bytes of the UTF-8 form, found for a
whole batch at once; a cut never falls into a character.

A sentinel is found where it was put and nowhere else: texts that hold one stay plain,
and as ``<`` is only ever the first character of a sentinel, none can arise from the end
of a part and the sentinel after it.

Edge cases: NULL and empty texts are empty and plain; so are texts that hold a sentinel
plain.  A part may be empty.  A NULL id draws as the text ``null``; rows that repeat an
id draw alike.  An empty table gives no rows; other columns pass through and those named
like a result are replaced.  Texts are taken whole, of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SEED = 1
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Hundredths of the texts that stay plain, and of the others that get the form spm.
PLAIN_PERCENT = 10
SPM_PERCENT = 20
#: Bytes that a reversal exchanges at a time.
BLOCK = 1 << 16

RESULTS = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


def reverse(buf: bytearray, start: int, stop: int) -> None:
    """Reverse a stretch in place, by blocks from both its ends."""
    while stop - start > 2 * BLOCK:
        head = buf[start : start + BLOCK]
        buf[start : start + BLOCK] = buf[stop - BLOCK : stop][::-1]
        buf[stop - BLOCK : stop] = head[::-1]
        start, stop = start + BLOCK, stop - BLOCK
    buf[start:stop] = buf[start:stop][::-1]


def rotate(buf: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchange the blocks start:middle and middle:stop by three reversals."""
    reverse(buf, start, middle)
    reverse(buf, middle, stop)
    reverse(buf, start, stop)


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """``text`` cut at two bytes, with sentinels, its blocks in the order of the form."""
    buf = bytearray(text)
    buf[second:second] = SUFFIX
    buf[first:first] = MIDDLE
    buf[0:0] = PREFIX
    middle = first + len(PREFIX)  # where the sentinel of the middle stands
    suffix = second + len(PREFIX) + len(MIDDLE)
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))
    return buf


def restore(output: bytes, form: str | None) -> bytes:
    """The text that ``arrange`` was given."""
    if form not in ("psm", "spm"):
        return output
    buf = bytearray(output)
    start = buf.index(SUFFIX)
    stop = buf.index(MIDDLE if form == "psm" else PREFIX)
    rotate(buf, start, stop, len(buf))
    for mark in (SUFFIX, MIDDLE, PREFIX):  # each before the next in the text, from its end
        at = buf.rindex(mark)
        del buf[at : at + len(mark)]
    return bytes(buf)


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers of 32 bits."""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def token_starts(data: np.ndarray) -> np.ndarray:
    """Where tokens of a text in UTF-8 begin."""
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def transform_text(text: bytes, doc_id: object, seed: int, plain: int, spm: int) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts = token_starts(data)
    n = len(starts)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= 100 - plain or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    form = "spm" if h4 % 100 < spm else "psm"
    places = np.append(starts, len(data))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = int(places[first]), int(places[second])
    return n, form, characters(data[:first]), characters(data[first:second]), bytes(arrange(text, first, second, form))


def _mapped(df: DataFrame, dropped: set[str], results: T.StructType, make: Callable) -> DataFrame:
    """``df`` without some columns, with those ``make`` computes from each Arrow batch."""
    kept = [c for c in df.columns if c not in dropped | set(results.names)]
    schema = T.StructType([*[df.schema[c] for c in kept], *results])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(kept)
            yield pa.RecordBatch.from_arrays([*rows.columns, *make(batch)], names=[*kept, *results.names])

    return df.mapInArrow(over, schema)


def _texts(column: pa.Array) -> Iterator[bytes]:
    """The bytes of each text; none for NULL."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def transform(
    docs: DataFrame,
    seed: int = SEED,
    plain: int = PLAIN_PERCENT,
    spm: int = SPM_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without the text, with ``n`` tokens, ``form``, ``prefix_chars`` and
    ``middle_chars`` (NULL if plain) and ``output``."""

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        ids = batch.column(id_col).to_pylist()
        texts = _texts(batch.column(text_col))
        found = [transform_text(text, i, seed, plain, spm) for i, text in zip(ids, texts, strict=True)]
        columns = list(zip(*found, strict=True)) or [()] * len(RESULTS)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return [*arrays[:-1], arrays[-1].cast(pa.string())]

    return _mapped(docs, {text_col}, RESULTS, make)


def invert(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``rows`` with ``restored``, the exact text of each output."""

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        forms = batch.column(form_col).to_pylist()
        texts = [restore(o, f) for o, f in zip(_texts(batch.column(output_col)), forms, strict=True)]
        return [pa.array(texts, pa.binary()).cast(pa.string())]

    return _mapped(rows, set(), T.StructType([T.StructField("restored", T.StringType())]), make)

