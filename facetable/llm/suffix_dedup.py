"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Of every document, each byte goes that is covered by a string of ``DEPTH`` bytes which
also starts in a document with a smaller id.  Suffixes are ordered through their first
``DEPTH`` bytes only, most significant digit first, and a group is given up as soon as it
lies within one document; the groups that are left at full depth are the repeated strings.

* The first digit is an anchor: the smallest hash of the short strings within those
  bytes.  Equal strings have equal anchors, and neighbouring suffixes mostly share
  one, so they travel as one run, named by two hashes, instead of one by one.
* Runs are gathered by anchor.  Of runs equal in all bytes, all but those of the smallest
  document are repeated throughout.  Anchors within one document, or with one run, are
  done.  What is left, some per cent, is asked for byte by byte.
* The bytes of these runs are gathered by anchor again and their suffixes sorted by
  digits of eight bytes to the full depth.

A task works on one bucket after another and holds the runs of one.  Copies within one
slice of the input are settled there and not sent, so a passage that
a third of all documents share costs one entry per slice.  An anchor with more than
``HOT`` different runs is split further: its suffixes are gathered by all their bytes.
Rows between the steps are packed: one row per slice and bucket.

Edge cases: NULL and short texts lose nothing and have an empty or whole rest; a NULL id
neither loses nor takes away; strings do not cross documents; a document's repeats
of itself stay.  Rows that repeat an id count as one document: what is found in one of
them is taken from each, at the same places.  Other columns pass through; those named
like a result are replaced.  Equal runs are told by 88 bits or more between slices (40 of
the anchor, with its bucket, and 48 of all bytes), and by 64 bits within one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetable.llm.shingles import LETTER, mix
from facetable.llm.tables import checkpointed, partitions

DEPTH = 50
ANCHOR = 20
#: Windows of one run at most.
LONGEST_RUN = 64
#: Different runs of one anchor that one task may gather.
HOT = 50_000
#: Buckets per shuffle partition.
SPREAD = 8
#: Spans and runs of several buckets that are answered together.
HELD = 500_000
#: Bytes whose suffixes are looked at together; some 150 MB of arrays.
SLICE = 1 << 21

_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2 to the 64
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Tables:
    """Powers of the base and of its inverse, made once per worker."""

    up = np.zeros(0, dtype=np.uint64)
    down = np.zeros(0, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(n, base, dtype=np.uint64)
                powers[0] = 1
                setattr(cls, name, powers.cumprod(dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def runs_of(data: np.ndarray, ends: np.ndarray, depth: int = DEPTH, anchor: int = ANCHOR):
    """Cut the suffixes of some texts, laid end to end, into runs.

    The first digit of a suffix is its anchor: the smallest hash of the ``anchor``-byte
    strings in its first ``depth`` bytes.  It depends on these bytes alone, so equal
    windows have equal anchors.  A run is a stretch of suffixes of one text with one
    anchor; it is given by its anchor, a hash of all its bytes, its first suffix and
    how many there are.
    """
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < depth:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    up, down = _Tables.of(max(n + 1, 1 << 16))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(LETTER[data] * up[:n], out=sums[1:])
    grams = mix((sums[anchor:] - sums[:-anchor]) * down[: n + 1 - anchor])
    reach = depth - anchor + 1
    low, size = grams, 1
    while 2 * size <= reach:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < reach:
        low = np.minimum(low[: len(low) - (reach - size)], low[reach - size :])
    valid = np.zeros(n, dtype=np.int32)  # whether a suffix has all its bytes in its text
    starts = np.concatenate([[0], ends[:-1]])
    has = ends - starts >= depth
    valid[starts[has]] += 1
    late = ends[has] - depth + 1
    np.subtract.at(valid, late, 1)
    at = np.flatnonzero(np.cumsum(valid)[: len(low)] > 0)
    if not len(at):
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    value = low[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(place % LONGEST_RUN == 0)
    count = np.diff(np.append(first, len(at)))
    begin = at[first]
    stop = begin + count - 1 + depth
    whole = mix((sums[stop] - sums[begin]) * down[begin] + count.astype(np.uint64))
    return value[first], whole, begin, count


# Rows that travel: where to, what it is, of which document, packed arrays.
ROUTED = "route bigint, kind int, doc_id bigint, payload binary"
RUNS, SPANS, WANTED = 0, 1, 2


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as bytes; each is stored byte plane by byte plane, so that
    the high bytes of small numbers compress to nothing."""
    n = len(columns[0])
    planes = [np.uint32(n).tobytes()]
    planes += [c.view(np.uint8).reshape(n, -1).T.tobytes() for c in columns]
    return b"".join(planes)


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = np.frombuffer(data, dtype=np.uint8)
    n, at, out = int(raw[:4].view(np.uint32)[0]), 4, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    out.append(raw[at:])
    return out


def narrow(values: np.ndarray, size: int) -> np.ndarray:
    """The low bytes of 64-bit numbers."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :size]).view(f"V{size}").reshape(-1)


def widen(values: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values), 8), dtype=np.uint8)
    out[:, : values.dtype.itemsize] = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return out.view(np.uint64).reshape(-1)


RUN_COLUMNS = ("V5", "V6", "i8", "i8", "u1")


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, in order; touching ones become one."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:], len(start)) - 1] if len(start) else reach


class Rows:
    """Collects rows of ``ROUTED`` for one Arrow batch."""

    def __init__(self) -> None:
        self.columns: tuple[list, list, list, list] = ([], [], [], [])

    def add(self, route: int | None, kind: int, doc: int | None, payload: bytes) -> None:
        for column, value in zip(self.columns, (route, kind, doc, payload), strict=True):
            column.append(value)

    def spans(self, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, buckets: int) -> None:
        """One row per document with the union of its intervals."""
        order = np.argsort(doc, kind="stable")
        doc, start, stop = doc[order], start[order], stop[order]
        for a, b in _groups(doc):
            self.add(int(doc[a]) % buckets, SPANS, int(doc[a]), pack(*merged(start[a:b], stop[a:b])))

    def batch(self) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(self.columns, kinds, strict=True)]
        self.columns = ([], [], [], [])
        return pa.RecordBatch.from_arrays(arrays, names=["route", "kind", "doc_id", "payload"])


def _groups(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of equal keys."""
    if len(keys):
        cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        yield from zip(np.append(0, cut).tolist(), np.append(cut, len(keys)).tolist(), strict=True)


def _segments(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Slices of about ``SLICE`` bytes: (doc, place, bytes).  A long text is cut; the parts
    overlap so that each suffix is whole in exactly one."""
    held, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            data = (text.as_py() or "").encode("utf-8", "replace")
            if not doc.is_valid or len(data) < depth:
                continue
            for at in range(0, len(data) - depth + 1, SLICE):
                held.append((doc.as_py(), at, data[at : at + SLICE + depth - 1]))
                size += len(held[-1][2])
                if size >= SLICE:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def send_runs(docs: DataFrame, buckets: int, depth: int = DEPTH) -> DataFrame:
    """Runs of all suffixes by bucket of their anchor, and what a slice settles itself."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _segments(batches, depth):
            held.sort(key=lambda s: s[:2])
            data = np.frombuffer(b"".join([s[2] for s in held]), dtype=np.uint8)
            sizes = np.array([len(s[2]) for s in held])
            ends = np.cumsum(sizes)
            anchor, whole, begin, count = runs_of(data, ends, depth)
            part = np.searchsorted(ends, begin, "right")
            doc = np.array([s[0] for s in held], dtype=np.int64)[part]
            place = begin - (ends - sizes)[part] + np.array([s[1] for s in held], dtype=np.int64)[part]
            # Equal runs side by side, smallest document first.
            order = np.argsort(whole, kind="stable")
            new = np.ones(len(order), dtype=bool)
            new[1:] = whole[order[1:]] != whole[order[:-1]]
            least = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            later = np.zeros(len(order), dtype=bool)
            later[order] = doc[order] > least
            rows = Rows()
            rows.spans(doc[later], place[later], place[later] + count[later] - 1 + depth, buckets)
            key = mix(anchor)  # the smallest of many hashes is not evenly spread; this is
            route = (key & np.uint64(0xFFFFFF)).astype(np.int64) % buckets
            sent = np.flatnonzero(~later)
            sent = sent[np.lexsort((doc[sent], route[sent]))]
            columns = (
                narrow(key[sent] >> np.uint64(24), 5), narrow(whole[sent], 6), doc[sent], place[sent],
                count[sent].astype(np.uint8),
            )
            for a, b in _groups(route[sent]):
                rows.add(int(route[sent[a]]), RUNS, None, pack(*[c[a:b] for c in columns]))
            yield rows.batch()

    return docs.select("doc_id", "text").mapInArrow(over, ROUTED)


def bucket_by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch | None, int, list[bytes]]]:
    """What passes through, and the payloads of one bucket after another.

    Rows come sorted by bucket, so a task holds one at a time, however many it is dealt.
    """
    now, held = -1, []
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (kind == SPANS).any():
            yield batch.filter(pa.array(kind == SPANS)), -1, []
        at = pa.array(np.flatnonzero(kind == RUNS))
        for route, payload in zip(
            batch.column("route").take(at).to_pylist(), batch.column("payload").take(at), strict=True
        ):
            if route != now:
                if held:
                    yield None, now, held
                now, held = route, []
            held.append(payload.as_py())
    if held:
        yield None, now, held


class Pending:
    """Columns that are gathered over several buckets, so that a document's share of all of
    them is one row."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.parts.append(columns)
            self.size += len(columns[0])

    def take(self) -> list[np.ndarray]:
        parts, self.parts, self.size = self.parts, [], 0
        return [np.concatenate(c) for c in zip(*parts, strict=True)]


def compare_runs(sent: DataFrame, buckets: int, depth: int = DEPTH, hot: int = HOT) -> DataFrame:
    """Per bucket: spans that are repeated throughout, and runs whose bytes are wanted."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, asked = Pending(), Pending()

        def answers() -> pa.RecordBatch:
            rows = Rows()
            if spans.size:
                rows.spans(*spans.take(), buckets)
            if asked.size:
                doc, *columns = asked.take()
                order = np.argsort(doc, kind="stable")
                doc, columns = doc[order], [c[order] for c in columns]
                for a, b in _groups(doc):
                    rows.add(None, WANTED, int(doc[a]), pack(*[c[a:b] for c in columns]))
            return rows.batch()

        for through, route, payloads in bucket_by_bucket(batches):
            if through is not None:
                yield through
                continue
            parts = [unpack(payload, *RUN_COLUMNS)[:-1] for payload in payloads]
            anchor, whole, doc, place, count = (np.concatenate(c) for c in zip(*parts, strict=True))
            anchor, whole = widen(anchor), widen(whole)
            order = np.lexsort((doc, whole, anchor))
            anchor, whole, doc, place, count = (c[order] for c in (anchor, whole, doc, place, count))
            new_anchor = np.append(True, anchor[1:] != anchor[:-1])
            new = new_anchor | np.append(True, whole[1:] != whole[:-1])
            group, of_anchor = np.cumsum(new) - 1, np.cumsum(new_anchor) - 1
            later = doc > doc[new][group]
            size = count.astype(np.int64) - 1 + depth
            spans.add(doc[later], place[later], (place + size)[later])
            first = np.flatnonzero(new_anchor)
            spread = np.maximum.reduceat(doc, first) > np.minimum.reduceat(doc, first)
            different = np.bincount(of_anchor[new])
            wanted = np.flatnonzero((spread & (different > 1))[of_anchor] & ~later)
            many = (different > hot)[of_anchor].astype(np.uint8)
            # The bucket is part of the anchor.
            anchor |= np.uint64(route) << np.uint64(40)
            asked.add(doc[wanted], anchor[wanted], place[wanted], count[wanted], many[wanted])
            if spans.size + asked.size >= HELD:
                yield answers()
        yield answers()

    return sent.repartition("route").sortWithinPartitions("route").mapInArrow(over, ROUTED)


def send_bytes(wanted: DataFrame, buckets: int, depth: int = DEPTH) -> DataFrame:
    """The bytes of the runs that are asked for (doc_id, text, wanted), by bucket."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Rows()
            routes, docs, places, counts, texts = [], [], [], [], []
            lone: dict[bytes, list[tuple[int, int]]] = {}
            for doc, text, asked in zip(*(batch.column(c) for c in ("doc_id", "text", "wanted")), strict=True):
                if not asked.is_valid:
                    continue
                data, doc = (text.as_py() or "").encode("utf-8", "replace"), doc.as_py()
                for payload in asked.as_py():
                    for anchor, place, count, many in zip(*unpack(payload, "u8", "i8", "u1", "u1")[:-1], strict=True):
                        place, count = int(place), int(count)
                        run = data[place : place + count - 1 + depth]
                        if len(run) < count - 1 + depth:
                            continue  # another row of the same id was meant
                        if not many:
                            routes.append(int(mix(np.array([anchor]))[0] % np.uint64(buckets)))
                            docs.append(doc)
                            places.append(place)
                            counts.append(count)
                            texts.append(run)
                            continue
                        for k in range(count):  # by all its bytes
                            lone.setdefault(run[k : k + depth], []).append((doc, place + k))
            later: list[tuple[int, int]] = []
            for string, where in lone.items():
                least = min(where)[0]
                route = int.from_bytes(string[:8], "little") ^ int.from_bytes(string[-8:], "little")
                route = int(mix(np.array([route], dtype=np.uint64))[0] % np.uint64(buckets))
                for doc, place in where:
                    if doc > least:
                        later.append((doc, place))
                    else:
                        routes.append(route)
                        docs.append(doc)
                        places.append(place)
                        counts.append(1)
                        texts.append(string)
            if later:
                doc, place = np.array(later, dtype=np.int64).T
                rows.spans(doc, place, place + depth, buckets)
            route = np.array(routes, dtype=np.int64)
            order = np.argsort(route, kind="stable")
            doc, place, count = (np.array(x, dtype=np.int64) for x in (docs, places, counts))
            for a, b in _groups(route[order]):
                o = order[a:b]
                head = pack(doc[o], place[o], count[o].astype(np.uint8))
                rows.add(int(route[o[0]]), RUNS, None, head + b"".join([texts[i] for i in o]))
            yield rows.batch()

    return wanted.mapInArrow(over, ROUTED)


def equal_suffixes(data: np.ndarray, suffix: np.ndarray, doc: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Which suffixes equal one of a smaller document in their first ``depth`` bytes.

    Passes by digits of eight bytes, most significant first.  After each, groups within
    one document are given up.
    """
    later = np.zeros(len(suffix), dtype=bool)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    digits = np.zeros(len(data) + 1, dtype=np.uint64)
    for k in range(8):
        digits[:-1] = (digits[:-1] << np.uint64(8)) | padded[k : k + len(data)]
    live = np.arange(len(suffix))
    group = np.zeros(len(suffix), dtype=np.int64)
    for at in range(0, depth, 8):
        digit = digits[suffix[live] + at]
        if at + 8 > depth:  # the last digit may be short
            digit = digit >> np.uint64(8 * (at + 8 - depth))
        order = np.lexsort((doc[live], digit, group))
        live, digit, group = live[order], digit[order], group[order]
        if not len(live):
            break
        new = np.append(True, (digit[1:] != digit[:-1]) | (group[1:] != group[:-1]))
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        d = doc[live]  # in order within a group
        kept = (d[np.append(first[1:], len(d)) - 1] > d[first])[group]
        least = d[first][group]
        if at + 8 >= depth:
            later[live[d > least]] = True
        live, group = live[kept], group[kept]
    return later


def sort_suffixes(sent: DataFrame, buckets: int, depth: int = DEPTH) -> DataFrame:
    """Per bucket: the spans of suffixes that a smaller document has as well."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = Pending()

        def answers() -> pa.RecordBatch:
            rows = Rows()
            if spans.size:
                rows.spans(*spans.take(), buckets)
            return rows.batch()

        for through, _, payloads in bucket_by_bucket(batches):
            if through is not None:
                yield through
                continue
            parts = [unpack(payload, "i8", "i8", "u1") for payload in payloads]
            doc, place, count, data = (np.concatenate(c) for c in zip(*parts, strict=True))
            count = count.astype(np.int64)
            size = count - 1 + depth
            run = np.repeat(np.arange(len(doc)), count)
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            later = equal_suffixes(data, (np.cumsum(size) - size)[run] + inner, doc[run], depth)
            start = (place[run] + inner)[later]
            spans.add(doc[run][later], start, start + depth)
            if spans.size >= HELD:
                yield answers()
        yield answers()

    return sent.repartition("route").sortWithinPartitions("route").mapInArrow(over, ROUTED)


def remove_repeats(docs: DataFrame, depth: int = DEPTH, hot: int = HOT) -> DataFrame:
    """``docs`` without ``text``, with ``kept`` (the bytes that stay), ``n_bytes``,
    ``n_removed`` and ``n_spans``."""
    buckets = SPREAD * partitions(docs.sparkSession)
    found = checkpointed(compare_runs(send_runs(docs, buckets, depth), buckets, depth, hot))

    def per_doc(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("doc_id").agg(F.collect_list("payload").alias(name))

    # Both joins have the same left side, so the texts are shuffled once and read twice.
    asked = docs.select("doc_id", "text").join(
        per_doc(found.where(F.col("kind") == WANTED), "wanted"), "doc_id", "left"
    )
    sorted_out = sort_suffixes(send_bytes(asked, buckets, depth), buckets, depth)
    spans = per_doc(found.where(F.col("kind") == SPANS).union(sorted_out), "spans")

    own = ("kept", "n_bytes", "n_removed", "n_spans", "spans")
    columns = [c for c in docs.columns if c not in (*own, "text")]
    schema = T.StructType(
        [
            *[docs.schema[c] for c in columns],
            T.StructField("kept", T.BinaryType()),
            *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, numbers = [], []
            for text, payloads in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = (text.as_py() or "").encode("utf-8", "replace")
                found = [unpack(p, "i8", "i8")[:-1] for p in payloads.as_py() or []]
                pairs = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.zeros(0, np.int64)] * 2
                start, stop = merged(*(np.minimum(x, len(data)) for x in pairs))
                start, stop = start[stop > start].tolist(), stop[stop > start].tolist()
                pieces = [data[a:b] for a, b in zip([0, *stop], [*start, len(data)], strict=True)]
                kept.append(b"".join(pieces))
                numbers.append((len(data), len(data) - len(kept[-1]), len(start)))
            rows = batch.select(columns)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(kept, pa.binary()), *[pa.array([n[k] for n in numbers], pa.int64()) for k in range(3)]],
                names=[*columns, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    rows = docs.select(*columns, "text").join(spans, "doc_id", "left")
    return rows.select(*columns, "text", "spans").mapInArrow(cut, schema)
