"""Benchmark decontamination by SimHash of item-sized windows.

A document is contaminated by an item if some window of as many words as the item has
a weighted Jaccard similarity of 0.75 or more with it; shingles of five words are
weighted by how often they occur.  Words are compared without ASCII punctuation and
with A-Z as a-z, so quotes and full stops around a passage do not hide it.

* Windows: for every length of an item, each window of a text that may hold an item.  A
  window in which too few shingles are in any item at all cannot reach the similarity with
  one, and gets no fingerprint; this takes nothing away.
* Fingerprints: a SimHash of ``BITS`` bits over the words of the window, weighted by how
  often they occur.
* Blocks: fingerprints are indexed in ``BITS / WIDTH`` blocks of bits.  Fingerprints that
  differ in fewer bits than there are blocks agree in one at least, so all items within
  that radius are candidates; so are others that share a block by chance.
* Verification: the exact weighted similarity of every candidate with its window decides.

Items are found through blocks only.  At similarity 0.75 windows share six of seven words
or more, a bit differs with 0.17 at most, and 0.96 or more of such pairs share a block;
at 0.85 it is 0.9995.  A passage is seen in several windows, so the recall of items is
higher; tests measure it.

Spark holds both sides: items and windows are tables of block keys that are joined, so the
plan is the same for any number of items.  Tasks get two bit tables of a fixed size at
most (``TABLE_BITS``): the shingles and the block keys of all items.  They let through all that is
in an item, and rarely more.  Windows are told from equal texts, which share them.

Edge cases: a NULL or empty text, and one without words, is clean; items without words
are left out; an item without an id counts, its id in the answer is NULL; items of one id
are one.  An item of fewer than five words is one shingle, as is such a text.  With
``short_anywhere`` it is found wherever its words stand; without, only in a text of as
many words, so "Yes" does not mark every text with that word.  ``short_items`` lists
them.  Equal items are all reported.  Repeated rows get equal answers.  Other columns pass
through, those named like a result are replaced.  A window of a text with fewer words than
the item is the whole text.  Empty tables give no rows, or clean ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetable.llm.shingles import LOWER, SIZE, mix, window_hashes, word_hashes, words_at
from facetable.llm.tables import settled, unused, words_of

THRESHOLD = 0.75
#: Bits of a fingerprint, and of one block of it.
BITS = 1024
WIDTH = 16
#: Bits of a table of shingles or keys: so many for each, and never more than these.
BITS_EACH, TABLE_BITS = 256, 1 << 26
#: Texts with leaks, and items in them, up to which their list is broadcast (some 20 MB).
BROADCAST = 200_000
#: First words of windows whose fingerprints are made together.
TOGETHER = 4096

PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_STEP = np.uint64(0x9E3779B97F4A7C15)


def normal_words(text: str | None) -> np.ndarray:
    """A hash per word."""
    data = (text or "").encode("utf-8", "replace").translate(LOWER, PUNCTUATION)
    starts, ends = words_at(data)
    return word_hashes(data, starts, ends)


def bit_sums(words: np.ndarray, bits: int = BITS) -> np.ndarray:
    """For each prefix of a list of words, the sums of their bits as +1 and -1."""
    values, back = np.unique(words, return_inverse=True)
    parts = [mix(values + np.array([k + 1], dtype=np.uint64) * _STEP) for k in range(bits // 64)]
    signs = np.unpackbits(np.stack(parts, axis=1).view(np.uint8), axis=1).astype(np.int32) * 2 - 1
    sums = np.zeros((len(words) + 1, bits), dtype=np.int32)
    np.cumsum(signs[back], axis=0, out=sums[1:])
    return sums


def fingerprints(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of the windows of ``length`` words that begin at ``starts``, as bytes."""
    return np.packbits(sums[starts + length] > sums[starts], axis=1)


def block_keys(prints: np.ndarray, size: int, n: int) -> np.ndarray:
    """A number for every block of every fingerprint, other ones for other lengths."""
    blocks = prints.view(np.uint16).astype(np.uint64)
    place = np.arange(blocks.shape[1], dtype=np.uint64) << np.uint64(16)
    kind = np.uint64(n * (SIZE + 1) + size)
    return mix(mix(blocks + place) + np.array([kind]) * _STEP).view(np.int64)


def least_shared(n: int, window: int) -> float:
    """Shingles that an item of ``n`` shares with a window at the threshold."""
    return THRESHOLD * (n + window) / (1 + THRESHOLD) - 1e-9


ITEMS = "row bigint, size int, n int, shingles binary, values array<bigint>, keys array<bigint>"


def index_items(benchmark: DataFrame, bits: int = BITS) -> DataFrame:
    """``ITEMS`` and ``item_id``, one row per item with words."""
    kind = benchmark.schema["item_id"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, columns = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                words = normal_words(text)
                if not len(words):
                    continue
                shingles = window_hashes(words)
                size, n = min(SIZE, len(words)), len(shingles)
                keys = block_keys(fingerprints(bit_sums(words, bits), np.zeros(1, np.int64), len(words)), size, n)
                values = np.unique(shingles).view(np.int64)
                row = int(mix(np.array([np.bitwise_xor.reduce(mix(shingles + np.arange(n, dtype=np.uint64)))]))[0] >> np.uint64(1))
                kept.append(k)
                columns.append((row, size, n, shingles.tobytes(), values.tolist(), np.unique(keys).tolist()))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            arrays = [pa.array(c, t) for c, t in zip(list(zip(*columns, strict=True)) or [[]] * 6, kinds, strict=True)]
            ids = batch.column("item_id").take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, *arrays], names=["item_id", "row", "size", "n", "shingles", "values", "keys"]
            )

    schema = T.StructType([T.StructField("item_id", kind.dataType), *T.StructType.fromDDL(ITEMS)])
    return benchmark.select("item_id", "text").mapInArrow(over, schema)


def bit_table(rows: DataFrame, column: str) -> np.ndarray:
    """A table with the bit of every number in ``column``: 8 MB at most."""
    numbers = rows.select(F.explode(column).alias("x"))
    wanted = max(1 << 12, BITS_EACH * numbers.count())
    size = min(TABLE_BITS, 1 << (wanted - 1).bit_length())
    at = F.col("x").bitwiseAND(F.lit(size - 1))
    words = numbers.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    table = np.zeros(size // 64, dtype=np.uint64)
    found = words.toArrow()
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def in_table(table: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = numbers.view(np.uint64) & np.uint64(64 * len(table) - 1)
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


class Seeker:
    """What a task knows of the items: their lengths, and two bit tables."""

    def __init__(self, lengths: dict[int, list[int]], shingles: np.ndarray, keys: np.ndarray, bits: int):
        self.lengths, self.shingles, self.keys, self.bits = lengths, shingles, keys, bits

    def windows(self, text: str | None, short_anywhere: bool) -> Iterator[tuple]:
        """Size, place and shingles of stretches, with their (n, start, key) of windows
        that have a block in common with some item."""
        words = normal_words(text)
        for size, lengths in self.lengths.items():
            if len(words) < size or (len(words) > size < SIZE and not short_anywhere):
                continue
            shingles = window_hashes(words, size)
            hit = in_table(self.shingles, shingles)
            total = int(hit.sum())
            if total < least_shared(lengths[0], min(lengths[0], len(shingles))):
                continue
            held = np.append(0, np.cumsum(hit))
            parts: list[tuple[np.ndarray, int, int]] = []
            for n in lengths:
                window = min(n, len(shingles))
                need = least_shared(n, window)
                if need > total:
                    break  # longer ones need more
                if need > window:
                    continue
                starts = np.flatnonzero(held[window:] - held[:-window] >= need)
                if window == 1:  # one place of each shingle says all
                    starts = starts[np.unique(shingles[starts], return_index=True)[1]]
                    starts.sort()
                if len(starts):
                    parts.append((starts, n, window))
            if parts:
                yield from self._stretches(list(self._known(words, parts, size)), shingles, size)

    def _known(self, words: np.ndarray, parts: list[tuple[np.ndarray, int, int]], size: int) -> Iterator[tuple]:
        """(start, stop, n, keys) of the windows with keys of items."""
        start = np.concatenate([p[0] for p in parts])
        which = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        order = np.argsort(start, kind="stable")
        start, which = start[order], which[order]
        length = np.array([p[2] for p in parts])[which] + size - 1
        reach = np.maximum.accumulate(start + length)
        at = 0
        while at < len(start):
            # Windows that overlap share the sums of their words.
            apart = np.flatnonzero(start[at + 1 :] > reach[at:-1])
            stop = at + 1 + int(apart[0]) if len(apart) else len(start)
            stop = min(stop, int(np.searchsorted(start, start[at] + TOGETHER)))
            first = int(start[at])
            sums = bit_sums(words[first : int((start + length)[at:stop].max())], self.bits)
            for k in np.unique(which[at:stop]).tolist():
                _, n, window = parts[k]
                mine = start[at:stop][which[at:stop] == k]
                keys = block_keys(fingerprints(sums, mine - first, window + size - 1), size, n)
                known = in_table(self.keys, keys.ravel()).reshape(keys.shape)
                for j in np.flatnonzero(known.any(axis=1)).tolist():
                    yield int(mine[j]), int(mine[j]) + window, n, keys[j][known[j]]
            at = stop

    def _stretches(self, found: list[tuple], shingles: np.ndarray, size: int) -> Iterator[tuple]:
        found.sort(key=lambda f: f[:3])
        k = 0
        while k < len(found):
            first, stop, mine = found[k][0], found[k][1], []
            while k < len(found) and found[k][0] < stop:
                mine.append(found[k])
                stop = max(stop, found[k][1])
                k += 1
            counts = [len(f[3]) for f in mine]
            yield (
                size, first, shingles[first:stop].tobytes(), np.repeat([f[2] for f in mine], counts).astype(np.int32),
                np.repeat([f[0] - first for f in mine], counts).astype(np.int32), np.concatenate([f[3] for f in mine]),
            )


STRETCHES = "k1 bigint, k2 bigint, size int, first int, shingles binary, n array<int>, start array<int>, key array<bigint>"


def text_keys(text: Column) -> tuple[Column, Column]:
    """Two hashes that stand for a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def find_windows(docs: DataFrame, seeker: Seeker, text_col: str, short_anywhere: bool) -> DataFrame:
    """``STRETCHES`` of texts with windows that share a block with an item."""
    shared = docs.sparkSession.sparkContext.broadcast(seeker)
    k1, k2 = text_keys(F.col(text_col))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for k, text in enumerate(batch.column("text")):
                for row in shared.value.windows(text.as_py(), short_anywhere):
                    keys.append(k)
                    rows.append(row)
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            arrays = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 6, kinds, strict=True)]
            at = pa.array(keys, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(at), batch.column("k2").take(at), *arrays],
                names=["k1", "k2", "size", "first", "shingles", "n", "start", "key"],
            )

    return docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text")).mapInArrow(over, STRETCHES)


VERIFIED = "k1 bigint, k2 bigint, similarity double, word int"


def verify(candidates: DataFrame) -> DataFrame:
    """The best window of each candidate at the threshold: exact weighted similarity."""
    kind = candidates.schema["item_id"].dataType

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = [], []
            columns = (batch.column(c).to_pylist() for c in ("first", "shingles", "item", "starts"))
            for k, (first, stretch, item, starts) in enumerate(zip(*columns, strict=True)):
                item, stretch = np.frombuffer(item, np.uint64), np.frombuffer(stretch, np.uint64)
                want, best = Counter(item.tolist()), (0.0, 0)
                for start in sorted(starts):
                    window = stretch[start : start + len(item)]
                    both = sum((want & Counter(window.tolist())).values())
                    best = max(best, (both / (len(item) + len(window) - both), -start))
                if best[0] >= THRESHOLD:
                    kept.append(k)
                    rows.append((best[0], first - best[1]))
            at = pa.array(kept, pa.int64())
            similarity, word = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(at) for c in ("item_id", "k1", "k2")),
                    pa.array(similarity, pa.float64()),
                    pa.array(word, pa.int32()),
                ],
                names=["item_id", "k1", "k2", "similarity", "word"],
            )

    schema = T.StructType([T.StructField("item_id", kind), *T.StructType.fromDDL(VERIFIED)])
    return candidates.select("item_id", "k1", "k2", "first", "shingles", "item", "starts").mapInArrow(over, schema)


def text_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", short_anywhere: bool = True, bits: int = BITS
) -> DataFrame:
    """k1, k2 (keys of a text), and the items it holds as ``leaks``; clean texts are left out."""
    items = settled(index_items(benchmark, bits))
    lengths: dict[int, list[int]] = {}
    for row in items.select("size", "n").distinct().collect():  # lengths of items, not items
        lengths.setdefault(row["size"], []).append(row["n"])
    lengths = {size: sorted(all_n) for size, all_n in sorted(lengths.items())}
    seeker = Seeker(lengths, bit_table(items, "values"), bit_table(items, "keys"), bits)
    stretches = settled(
        find_windows(docs, seeker, text_col, short_anywhere).dropDuplicates(["k1", "k2", "size", "first"])
    )
    stretch = ["k1", "k2", "size", "first"]
    seen = stretches.select(*stretch, F.explode(F.arrays_zip("n", "start", "key")).alias("w")).select(*stretch, "w.*")
    keyed = items.select("item_id", "row", "size", "n", F.explode("keys").alias("key"))
    candidates = (
        seen.join(keyed, ["key", "size", "n"])
        .groupBy(*stretch, "item_id", "row", "n")
        .agg(F.collect_set("start").alias("starts"))
    )
    whole = items.select("item_id", "row", "n", F.col("shingles").alias("item")).dropDuplicates(["item_id", "row", "n"])
    same = F.col("c.item_id").eqNullSafe(F.col("i.item_id")) & (F.col("c.row") == F.col("i.row")) & (F.col("c.n") == F.col("i.n"))
    candidates = candidates.alias("c").join(whole.alias("i"), same).select("c.*", "i.item")
    found = verify(candidates.join(stretches.select(*stretch, "shingles"), stretch))
    best = found.groupBy("k1", "k2", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("word")).alias("before"))).alias("best")
    )
    leak = F.struct(
        "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.before")).alias("word")
    )
    return best.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(leak)).alias("leaks"))


def listed(leaks: DataFrame) -> DataFrame:
    """Texts with leaks, to be joined with the documents: broadcast if there are few enough,
    so that whole texts need not be shuffled; otherwise Spark joins by sorting."""
    found = settled(leaks)
    size = found.agg(F.count("*") + F.coalesce(F.sum(F.size("leaks")), F.lit(0))).first()[0]
    return F.broadcast(found) if size <= BROADCAST else found


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    short_anywhere: bool = True,
    bits: int = BITS,
) -> DataFrame:
    """``docs`` with ``leaks``: the items each one holds, with similarity and place."""
    columns = [c for c in docs.columns if c != "leaks"]
    docs = docs.select(*columns)
    leaks = listed(text_leaks(docs, benchmark, text_col, short_anywhere, bits))
    names = unused([*columns, "leaks"], "k1", "k2")
    found = leaks.select(F.col("k1").alias(names[0]), F.col("k2").alias(names[1]), "leaks")
    keyed = docs.select("*", *[k.alias(c) for k, c in zip(text_keys(F.col(text_col)), names, strict=True)])
    none = F.array().cast(leaks.schema["leaks"].dataType)
    return keyed.join(found, names, "left").select(*columns, F.coalesce("leaks", none).alias("leaks"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", short_anywhere: bool = True
) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    columns = [c for c in docs.columns if c != "leaks"]
    docs = docs.select(*columns)
    leaks = listed(text_leaks(docs, benchmark, text_col, short_anywhere))
    names = unused(columns, "k1", "k2")
    keyed = docs.select("*", *[k.alias(c) for k, c in zip(text_keys(F.col(text_col)), names, strict=True)])
    found = leaks.select(F.col("k1").alias(names[0]), F.col("k2").alias(names[1]))
    return keyed.join(found, names, "left_anti").select(*columns)


def short_items(benchmark: DataFrame) -> DataFrame:
    """The items of fewer than five words, with their number of words."""
    words = words_of(F.translate("text", PUNCTUATION.decode(), ""))
    return benchmark.select("item_id", "text", F.size(words).alias("n_words")).where(
        (F.col("n_words") > 0) & (F.col("n_words") < SIZE)
    )
