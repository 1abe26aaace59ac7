"""Alignment of two tokenizers by the pairs of tokens that they put in one place.

Both tokenizers cut the same bytes.  Offsets where tokens of both end cut a text into
groups; a token of A and one of B are linked if they share a group.  Per pair of ids the
documents that hold it linked are counted, over the whole corpus, and each document gets
back what its own links are worth.

External spill counting:

* Spill: texts are taken in slices.  The links of a slice become sorted records (A id,
  B id, document, times), dealt by radix of the pair, and are written as zstd runs: a head
  (pairs in order, documents of each) and a body (document numbers and times).  Runs are
  rows of a table in the shared folder, so a lost executor repeats its slices only.
* Count: the heads of a radix meet in one task.  A heap holds the first pair of the next
  block of every run; all that lies below it is counted and final, so a task holds a few
  blocks of each run and the counts.  Pairs come A-major, so the largest count of each A id
  ends with its last pair.
* Contributions go back as one array of counts per run, in the order of its head, and meet
  the bodies slice by slice, where each document sums what its records are worth.

Hot ids: what is shuffled is one entry per slice and pair, not per document, and an A id is
dealt over ``SPLIT`` radices by its B ids, so an id that is in every document neither
gathers its documents nor fills one task.  The largest counts of all A ids are brought
to the driver and sent to the tasks: one number per A id of the vocabulary, at most.

Edge cases: NULL and empty texts have no tokens, and so have texts whose tokens do not join
to the text (where B normalises, or has no token for a character); strings of special
tokens are plain text.  Texts are tokenized whole.  Rows are documents of their own, even
if they repeat an id; a NULL id is kept.  An empty table gives no rows.  Other columns but
the text pass through, those named like a result are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetable.llm.bpe import byte_letters, tokenizer_path
from facetable.llm.tables import partitions, settled

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: How A cuts texts before it merges: a fixed value of byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space in a row that is left to the first library.
RUN = 1000
#: Bytes of text in a slice; characters that a library encodes together.
SLICE = 4 << 20
PIECE = 1 << 16
#: Links that stand as arrays at one time.
LINKS = 1 << 19
#: Radices per shuffle partition, and radices that one A id is dealt over.
SPREAD = 2
SPLIT = 64
#: Pairs in a block of a head, and pairs that are counted together.
BLOCK = 1024
COUNTED = 1 << 18

#: Bits of a B id within the code of a pair.
B_BITS = 16

MEASURES = ("n_a", "n_b", "n_groups", "n_links")
RESULTS = (*MEASURES, "n_best", "count_sum", "groups_sha256")


class Pair:
    """Both tokenizers of a worker, and the bytes of their tokens.

    A is a byte-level vocabulary whose ids are in the order of its merges, so a second
    library that takes such a vocabulary as ranks encodes the same, in a quarter of the
    time.  It has letter tables of its own and no room for long runs of white space: a text
    with a letter that this Python does not know, or with ``RUN`` white space characters in
    a row, is left to the first library.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tiktoken

        self.path_a = path_a
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = {letter: byte for byte, letter in enumerate(byte_letters())}
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.bytes_a = [b""] * (max(model["vocab"].values()) + 1)
        for token, i in model["vocab"].items():
            self.bytes_a[i] = bytes(value[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][x + y] for x, y in merges]
        if made != list(range(256, 256 + len(made))):
            raise ValueError(f"the ids of {path_a} are not in the order of its merges")
        ranks = {token: i for i, token in enumerate(self.bytes_a) if token}
        self.fast = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(t) for t in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(t) for t in self.bytes_b], dtype=np.int64)
        self.known: set[str] = set()
        self.run = re.compile(rf"\s{{{RUN}}}")
        # Decimal ids and what follows them: A "," or "|", B "," or ";".
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        self.shift = (0, n_a, 2 * n_a, 2 * n_a + n_b)
        self.decimal = pa.array(
            [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)]
        )

    @functools.cached_property
    def exact(self):
        """The first library of A, which most workers never need."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path_a)
        library.encode_special_tokens = True
        library.no_truncation()
        library.no_padding()
        return library

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def is_plain(self, text: str) -> bool:
        """Whether both libraries of A cut a text alike."""
        if not text.isascii() and (fresh := set(text) - self.known):
            self.known |= {c for c in fresh if unicodedata.category(c) != "Cn"}
            if fresh - self.known:
                return False
        return not self.run.search(text)

    def encode_a(self, text: str) -> list[int]:
        if self.is_plain(text):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """Of both: ids of all texts, and how many each has; none for a text that the
        tokens do not join to."""
        ids_a, ids_b = [], []
        for at in _pieces(texts):
            ids_b += self.b.encode(texts[at], num_threads=1)
        for k, text in enumerate(texts):
            whole = f" {text}"
            a, b = self.encode_a(whole), ids_b[k]
            joined = whole.encode()
            if (
                not text
                or b"".join(map(self.bytes_a.__getitem__, a)) != joined
                or b"".join(map(self.bytes_b.__getitem__, b)) != joined
            ):
                a = b = []
            ids_a.append(np.array(a, dtype=np.int32))
            ids_b[k] = np.array(b, dtype=np.int32)
        none = np.zeros(0, np.int32)
        return tuple(
            (np.concatenate([none, *ids]), np.array(list(map(len, ids)), dtype=np.int64)) for ids in (ids_a, ids_b)
        )


def _pieces(texts: list[str]) -> Iterator[slice]:
    """Stretches of about ``PIECE`` characters."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= PIECE:
            yield slice(start, k + 1)
            start, held = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


@functools.lru_cache(maxsize=1)
def pair(path_a: str, path_b: str) -> Pair:
    """One per worker process."""
    return Pair(path_a, path_b)


class Groups:
    """The groups of some texts, laid end to end."""

    def __init__(self, both: Pair, of_a: tuple[np.ndarray, np.ndarray], of_b: tuple[np.ndarray, np.ndarray]):
        (a, self.n_a), (b, self.n_b) = of_a, of_b
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        end_a, end_b = np.cumsum(both.size_a[self.a]), np.cumsum(both.size_b[self.b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        #: The group of each token; texts end together, so no group spans two of them.
        self.of_a, self.of_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        self.size_a = np.bincount(self.of_a, minlength=len(common))
        self.size_b = np.bincount(self.of_b, minlength=len(common))
        docs = len(self.n_a)
        doc_of_a = np.repeat(np.arange(docs), self.n_a)
        #: The text of each group, by its last A token.
        self.doc = doc_of_a[np.cumsum(self.size_a) - 1] if len(common) else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.doc, minlength=docs)
        self.links = self.size_a * self.size_b
        self.n_links = np.bincount(self.doc, self.links, minlength=docs).astype(np.int64)

    def digests(self, both: Pair) -> list[str]:
        """The hash of the groups of each text as decimal ids; '' without tokens."""
        last_a = np.append(self.of_a[1:] != self.of_a[:-1], True)[: len(self.a)]
        last_b = np.append(self.of_b[1:] != self.of_b[:-1], True)[: len(self.b)]
        at_a = np.arange(len(self.a)) + (np.cumsum(self.size_b) - self.size_b)[self.of_a]
        at_b = np.arange(len(self.b)) + np.cumsum(self.size_a)[self.of_b]
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        order[at_a] = self.a + np.where(last_a, both.shift[1], both.shift[0])
        order[at_b] = self.b + np.where(last_b, both.shift[3], both.shift[2])
        ends = np.append(0, np.cumsum(self.n_a + self.n_b)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), both.decimal.take(pa.array(order)))
        joined = pc.binary_join(lists, "").to_pylist()
        return [hashlib.sha256(text[:-1].encode()).hexdigest() if text else "" for text in joined]

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair code, text and times of all links, in this order.

        Groups are taken together up to ``LINKS`` links; a longer one is cut along A.
        """
        start_b = np.cumsum(self.size_b) - self.size_b
        # One row per A token: all B tokens of its group.
        width = self.size_b[self.of_a]
        done = np.cumsum(width)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        first = 0
        while first < len(self.a):
            base = done[first] - width[first]
            stop = max(first + 1, int(np.searchsorted(done, base + LINKS, "right")))
            w = width[first:stop]
            inner = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            group = self.of_a[first:stop]
            b = self.b[np.repeat(start_b[group], w) + inner]
            code = (np.repeat(self.a[first:stop], w) << B_BITS) | b
            key = (code << 31) | np.repeat(self.doc[group], w)
            parts.append(_summed([(key, np.ones(len(key), np.int64))]))
            if len(parts) > 8:
                parts = [_summed(parts)]
            first = stop
        key, times = _summed(parts)
        return key >> 31, key & 0x7FFFFFFF, times


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their numbers."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[first], np.add.reduceat(n[order], first) if len(first) else n


# --- runs ------------------------------------------------------------------------------


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Numbers byte plane by byte plane, so that high bytes of small ones vanish."""
    return values.astype(kind).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(raw: bytes, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, np.uint8, n * size).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n).astype(np.int64)


def pack_head(code: np.ndarray, docs: np.ndarray) -> bytes:
    """Pairs in order and their documents, in blocks that can be read one by one."""
    zip_, frames, firsts = zstandard.ZstdCompressor(level=1), [], []
    for at in range(0, len(code), BLOCK):
        c = code[at : at + BLOCK]
        firsts.append(c[0])
        frames.append(zip_.compress(_planes(np.diff(c, prepend=c[0]), "u4") + _planes(docs[at : at + BLOCK], "u4")))
    index = np.array([firsts, [min(BLOCK, len(code) - BLOCK * k) for k in range(len(frames))], list(map(len, frames))])
    return np.uint32(len(frames)).tobytes() + index.astype("i8").tobytes() + b"".join(frames)


class Head:
    """Reads the blocks of a packed head, one after another."""

    def __init__(self, data: bytes):
        n = int(np.frombuffer(data, np.uint32, 1)[0])
        self.first, self.count, size = np.frombuffer(data, "i8", 3 * n, 4).reshape(3, n).tolist()
        self.at = 4 + 24 * n + np.append(0, np.cumsum(size)).astype(np.int64)
        self.data, self.next = data, 0

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        k, self.next = self.next, self.next + 1
        raw = zstandard.ZstdDecompressor().decompress(self.data[self.at[k] : self.at[k + 1]])
        n = self.count[k]
        return self.first[k] + np.cumsum(_from_planes(raw, n, "u4")), _from_planes(raw[4 * n :], n, "u4")

    def ahead(self) -> int | None:
        """The first pair of the next block."""
        return self.first[self.next] if self.next < len(self.first) else None


def merge_heads(heads: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Count pairs over runs: (run and count of each entry, in run order), (pair, count).

    A heap gives the run whose next block begins with the smallest pair.  Blocks are read
    until ``COUNTED`` entries are held; all pairs below the top of the heap are final.
    """
    runs = [Head(data) for data in heads]
    heap = [(run.ahead(), k) for k, run in enumerate(runs) if run.ahead() is not None]
    heapq.heapify(heap)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    while heap:
        _, k = heapq.heappop(heap)
        code, docs = runs[k].read()
        held.append((code, docs, np.full(len(code), k)))
        size += len(code)
        if (ahead := runs[k].ahead()) is not None:
            heapq.heappush(heap, (ahead, k))
        if heap and size < COUNTED:
            continue
        code, docs, run = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(code, kind="stable")
        code, docs, run = code[order], docs[order], run[order]
        stop = np.searchsorted(code, heap[0][0]) if heap else len(code)
        held, size = [(code[stop:], docs[stop:], run[stop:])], len(code) - stop
        if not stop:
            continue
        code, docs, run = code[:stop], docs[:stop], run[:stop]
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        total = np.add.reduceat(docs, first)
        each = np.repeat(total, np.diff(np.append(first, stop)))
        back = np.argsort(run, kind="stable")  # pairs of a run stay in order
        yield run[back], each[back], code[first], total


# --- stages ----------------------------------------------------------------------------

# A document, or a run of a slice: the columns of documents are NULL in runs.
RUN_FIELDS = [
    T.StructField("slice", T.LongType()),
    T.StructField("place", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in MEASURES],
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("radix", T.IntegerType()),
    T.StructField("head", T.BinaryType()),
    T.StructField("body", T.BinaryType()),
]


def radix_of(code: np.ndarray, radices: int) -> np.ndarray:
    """A-major within a radix; the B ids of an A id go to ``SPLIT`` radices at most."""
    mixed = ((code >> B_BITS) * SPLIT + (code % SPLIT)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(radices)).astype(np.int64)


def runs_of_slice(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], radices: int) -> Iterator[tuple]:
    """Radix, head and body of each run of a slice."""
    code, doc, times = (np.concatenate(c) for c in zip(*parts, strict=True))
    if not len(code):  # no text has tokens
        return
    radix = radix_of(code, radices)
    order = np.lexsort((doc, code, radix))
    code, doc, times, radix = code[order], doc[order], times[order], radix[order]
    cut = np.flatnonzero(np.append(True, radix[1:] != radix[:-1]))
    zip_ = zstandard.ZstdCompressor(level=1)
    for a, b in zip(cut, np.append(cut[1:], len(radix)), strict=True):
        c = code[a:b]
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        docs = np.diff(np.append(first, len(c)))
        body = _planes(doc[a:b], "u4") + _planes(times[a:b], "u4")
        yield int(radix[a]), pack_head(c[first], docs), np.uint32(b - a).tobytes() + zip_.compress(body)


def spill(
    docs: DataFrame, radices: int, paths: tuple[str, str], text_col: str, kept: list[str], slice_bytes: int = SLICE
) -> DataFrame:
    """Documents with their measures, and the runs of each slice."""
    # Own names are positions, so that columns of any name can pass through.
    own = [T.StructField(f"c{k}", docs.schema[c].dataType) for k, c in enumerate(kept)]
    frame = docs.select(F.col(text_col).alias("t"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(kept)])
    schema = T.StructType([*own, *RUN_FIELDS])
    names = [f"c{k}" for k in range(len(kept))]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(*paths)
        base, made = TaskContext.get().partitionId() << 32, 0
        parts: list[tuple] = []
        held, place = 0, 0

        def runs() -> pa.RecordBatch:
            rows = list(runs_of_slice(parts, radices))
            n = len(rows)
            radix, head, body = zip(*rows, strict=True) if rows else ((), (), ())
            arrays = {
                "slice": pa.array([base + made] * n, pa.int64()), "radix": pa.array(radix, pa.int32()),
                "head": pa.array(head, pa.binary()), "body": pa.array(body, pa.binary()),
            }
            fields = arrow_fields
            return pa.RecordBatch.from_arrays(
                [arrays[f.name] if f.name in arrays else pa.nulls(n, f.type) for f in fields], schema=pa.schema(fields)
            )

        arrow_fields: list[pa.Field] = []
        for batch in batches:
            if not arrow_fields:
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.int32(), pa.binary(), pa.binary()]
                arrow_fields = [
                    *[pa.field(c, batch.schema.field(c).type) for c in names],
                    *[pa.field(f.name, k) for f, k in zip(RUN_FIELDS, kinds, strict=True)],
                ]
            sizes = pc.fill_null(pc.binary_length(batch.column("t")), 0).to_numpy(zero_copy_only=False)
            ends, start = np.cumsum(sizes), 0
            while start < batch.num_rows:
                # Rows whose texts fit what is left of the slice, one at least.
                room = slice_bytes // 8 + (ends[start - 1] if start else 0)
                stop = max(start + 1, int(np.searchsorted(ends, room, "right")))
                part = batch.slice(start, stop - start)
                ids = both.encode([t or "" for t in part.column("t").to_pylist()])
                groups = Groups(both, *ids)
                code, doc, times = groups.records()
                parts.append((code, doc + place, times))
                n = part.num_rows
                measures = (groups.n_a, groups.n_b, groups.n_groups, groups.n_links)
                arrays = {
                    "slice": pa.array([base + made] * n, pa.int64()),
                    "place": pa.array(np.arange(place, place + n, dtype=np.int32)),
                    **{c: pa.array(m, pa.int64()) for c, m in zip(MEASURES, measures, strict=True)},
                    "groups_sha256": pa.array(groups.digests(both), pa.string()),
                    **{c: part.column(c) for c in names},
                }
                yield pa.RecordBatch.from_arrays(
                    [arrays[f.name] if f.name in arrays else pa.nulls(n, f.type) for f in arrow_fields],
                    schema=pa.schema(arrow_fields),
                )
                place += n
                held += int(ends[stop - 1] - (ends[start - 1] if start else 0))
                start = stop
                if held >= slice_bytes:
                    yield runs()
                    made, parts, held, place = made + 1, [], 0, 0
        if parts:
            yield runs()

    return frame.mapInArrow(over, schema)


COUNTS = "slice bigint, radix int, counts binary, a int, best bigint"


def count(heads: DataFrame) -> DataFrame:
    """Per run the counts of its pairs; and per radix the largest count of each A id."""

    def of_radix(radix: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        counts: list[list[np.ndarray]] = [[] for _ in rows]
        best_a, best = [], []
        for run, each, code, total in merge_heads([head for _, head in rows]):
            cut = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            for a, b in zip(cut, np.append(cut[1:], len(run)), strict=True):
                counts[run[a]].append(each[a:b])
            a = code >> B_BITS
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            best_a.append(a[first])
            best.append(np.maximum.reduceat(total, first))
        zip_ = zstandard.ZstdCompressor(level=1)
        packed = []
        for c in counts:
            values = np.concatenate([np.zeros(0, np.int64), *c])
            packed.append(np.uint32(len(values)).tobytes() + zip_.compress(_planes(values, "i8")))
        a, top = np.concatenate(best_a), np.concatenate(best)
        n, m = len(rows), len(a)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([s for s, _ in rows] + [None] * m, pa.int64()),
                pa.array([radix] * n + [None] * m, pa.int32()),
                pa.array(packed + [None] * m, pa.binary()),
                pa.array([None] * n + a.tolist(), pa.int32()),
                pa.array([None] * n + top.tolist(), pa.int64()),
            ],
            names=["slice", "radix", "counts", "a", "best"],
        )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for radix, part, head in zip(*(batch.column(c).to_pylist() for c in ("radix", "slice", "head")), strict=True):
                if radix != now and rows:
                    yield of_radix(now, rows)
                    rows = []
                now = radix
                rows.append((part, head))
        if rows:
            yield of_radix(now, rows)

    return heads.repartition("radix").sortWithinPartitions("radix").mapInArrow(over, COUNTS)


WORTH = "slice bigint, place int, n_best bigint, count_sum bigint"


def contributions(bodies: DataFrame, counted: DataFrame, best: np.ndarray) -> DataFrame:
    """What the links of each document are worth: bodies (slice, radix, head, body) meet
    their counts slice by slice."""
    context = bodies.sparkSession.sparkContext
    largest = context.broadcast(best)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, tops = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: dict[int, bytes] = {}

        def rows() -> pa.RecordBatch:
            n = len(sums)
            return pa.RecordBatch.from_arrays(
                [pa.array([now] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array(tops), pa.array(sums)],
                names=["slice", "place", "n_best", "count_sum"],
            )

        def grown(values: np.ndarray, n: int) -> np.ndarray:
            return values if n <= len(values) else np.concatenate([values, np.zeros(n - len(values), np.int64)])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("slice", "radix", "head", "body", "counts"))
            for part, radix, head, body, counts in zip(*columns, strict=True):
                if part != now:
                    if len(sums):
                        yield rows()
                    now, sums, tops, waiting = part, np.zeros(0, np.int64), np.zeros(0, np.int64), {}
                if counts is not None:  # sorted before the body of the same radix
                    waiting[radix] = counts
                    continue
                pairs, docs = (np.concatenate(c) for c in zip(*_blocks(head), strict=True))
                n = int(np.frombuffer(body, np.uint32, 1)[0])
                raw = zstandard.ZstdDecompressor().decompress(body[4:])
                doc, times = _from_planes(raw, n, "u4"), _from_planes(raw[4 * n :], n, "u4")
                packed = waiting.pop(radix)
                value = _from_planes(zstandard.ZstdDecompressor().decompress(packed[4:]), len(pairs), "i8")
                is_best = value == largest.value[pairs >> B_BITS]
                size = int(doc.max()) + 1
                sums, tops = grown(sums, size), grown(tops, size)
                np.add.at(sums, doc, times * np.repeat(value, docs))
                np.add.at(tops, doc, times * np.repeat(is_best, docs))
        if len(sums):
            yield rows()

    both = bodies.select("slice", "radix", "head", "body", F.lit(None).cast("binary").alias("counts")).unionByName(
        counted.select(
            "slice", "radix", F.lit(None).cast("binary").alias("head"), F.lit(None).cast("binary").alias("body"), "counts"
        )
    )
    by_slice = both.repartition("slice").sortWithinPartitions("slice", "radix", F.col("counts").isNull())
    return by_slice.mapInArrow(over, WORTH)


def _blocks(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    head = Head(data)
    while head.ahead() is not None:
        yield head.read()


def largest_counts(counted: DataFrame) -> np.ndarray:
    """The largest count of each A id: one row per id of the vocabulary at most."""
    rows = counted.where(F.col("a").isNotNull()).groupBy("a").agg(F.max("best").alias("best")).collect()
    best = np.zeros(1 + max((r.a for r in rows), default=0), dtype=np.int64)
    for r in rows:
        best[r.a] = r.best
    return best


def align(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    text_col: str = "text",
    slice_bytes: int = SLICE,
) -> DataFrame:
    """``docs`` without the text, with the numbers of tokens, groups and links of each
    text, what its links are worth in the corpus, and a hash of its groups."""
    paths = (path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B))
    kept = [c for c in docs.columns if c not in (text_col, *RESULTS)]
    spilled = settled(spill(docs, SPREAD * partitions(docs.sparkSession), paths, text_col, kept, slice_bytes))
    runs = spilled.where(F.col("radix").isNotNull())
    counted = settled(count(runs.select("slice", "radix", "head")))
    worth = contributions(
        runs.select("slice", "radix", "head", "body"), counted.where(F.col("a").isNull()), largest_counts(counted)
    )
    rows = spilled.where(F.col("radix").isNull()).drop("radix", "head", "body")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return rows.join(worth, ["slice", "place"], "left").select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], *MEASURES, *zero, "groups_sha256"
    )
