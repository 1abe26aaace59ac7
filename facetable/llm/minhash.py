"""Near duplicates by min-max hashing, banding and exact confirmation.

Every permutation gives two values of a document's set of word shingles, the smallest
and the largest, so a signature of ``2 * PERMUTATIONS`` values costs half the
hashes.  ``ROWS`` values make a band; documents that share a band are candidates, and
a candidate pair is linked only if the Jaccard similarity of the full sets (64-bit
hashes of the shingles) reaches the threshold.  With 40 bands of 5, a pair at 0.75
shares no band with probability 2e-5, at 0.8 with 1e-7.

No group is ever turned into all its pairs, yet no link is given up:

1. equal sets are one class, represented by its smallest id (a partial aggregate);
2. in each band group, members are confirmed against the smallest member, and the
   connected components of these links are found;
3. what is left are band groups whose members are in several components.  A member stays
   only if it could have a partner in another one: of two sets at the threshold, the
   rarest shingles of one (its prefix) meet those of the other.  Shingles are counted, not
   paired, so texts that share a frame but are not alike drop out however many they are;
4. members outside a group's largest component are compared with all the others, in
   chunks: a task holds about ``LEFT`` sets and ``LEFT_SHINGLES`` shingles at most, or one
   set, streams about ``RIGHT`` past them, and returns one link per pair of components.
   Pairs within a component need no look.

Edge cases: a NULL or empty text, or one without words, has an empty set, is linked
with nothing and is its own component; fewer words than a shingle make one shingle.
Ties go to the smallest id.  Repeated rows with one id are one node.  A NULL id is
linked with nothing, has a NULL component and is kept.  Other columns are not looked
at; ``deduplicate`` returns all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetable.llm.components import components
from facetable.llm.shingles import mix, shingle_set
from facetable.llm.tables import checkpointed

THRESHOLD = 75  # per cent
PERMUTATIONS = 100
ROWS = 5
LEFT, RIGHT = 256, 1024
#: Shingles of the sets that a task holds; some 50 MB.
LEFT_SHINGLES = 2_000_000
#: Counters by which shingles are ordered from rare to frequent: a table of half a MB.
COUNTERS = 1 << 16

_rng = np.random.default_rng(20)
_FACTOR = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation, in turn; minimum and maximum of one
    permutation are placed apart, so that a band has values of different ones."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):  # bounds the memory for very long texts
        values = shingles[at : at + 2048, None] * _FACTOR + _SHIFT
        low = np.minimum(low, values.min(axis=0))
        high = np.maximum(high, values.max(axis=0))
    return np.stack([low, np.roll(high, PERMUTATIONS // 2)], axis=1).ravel()


def bands(shingles: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    values = signature(shingles).reshape(-1, ROWS)
    keys = np.arange(1, len(values) + 1, dtype=np.uint64)
    for column in values.T:
        keys = mix(keys + column)
    return keys.view(np.int64)


def sketch(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): set size, two hashes of the set, bands."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                s = shingle_set(text.as_py())
                if len(s):
                    total = mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s + np.uint64(7)))
                    out.append((len(s), *(int(np.int64(x.view(np.int64))) for x in total), bands(s)))
                else:
                    out.append((0, 0, 0, None))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    *[pa.array([row[k] for row in out], pa.int64()) for k in range(3)],
                    pa.array([row[3] for row in out], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "h1", "h2", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        over, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>"
    )


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id`` and ``shingles`` (packed 64-bit hashes) of the documents in ``wanted``."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py()).tobytes() for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.binary())],
                names=["doc_id", "shingles"],
            )

    texts = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    return texts.mapInArrow(over, "doc_id bigint, shingles binary")


def confirm(tasks: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) between the left and the right documents of each task.

    ``tasks`` has task, side (0 left, 1 right), doc_id and label.  Documents of equal
    label are not compared, and each pair of labels is returned once per task.
    """

    def links(left: list, doc: int, label: int, right: np.ndarray, flat: tuple) -> Iterator[tuple[int, int]]:
        values, owner = flat
        low, high = np.searchsorted(values, right, "left"), np.searchsorted(values, right, "right")
        count = high - low
        at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        shared = np.bincount(owner[at], minlength=len(left))
        for k in np.flatnonzero(shared):
            doc_left, label_left, s = left[k]
            union = len(s) + len(right) - shared[k]
            if label_left != label and doc_left != doc and 100 * shared[k] >= threshold * union:
                yield doc_left, label_left

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, left, flat, done = None, [], None, set()
        for batch in batches:
            found = []
            rows = zip(*(batch.column(c) for c in ("task", "side", "doc_id", "label", "shingles")), strict=True)
            for row in rows:
                name, side, doc, label, packed = (x.as_py() for x in row)
                if name != task:
                    task, left, flat, done = name, [], None, set()
                s = np.frombuffer(packed, dtype=np.uint64)
                if side == 0:
                    left.append((doc, label, s))
                    continue
                if flat is None:
                    if not left:
                        continue
                    values = np.concatenate([x[2] for x in left])
                    owner = np.repeat(np.arange(len(left)), [len(x[2]) for x in left])
                    order = np.argsort(values, kind="stable")
                    flat = values[order], owner[order]
                for other, its_label in links(left, doc, label, s, flat):
                    if (its_label, label) not in done:
                        done.add((its_label, label))
                        found.append((other, doc))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    ready = (
        tasks.join(sets, "doc_id")
        .repartition("task")
        .sortWithinPartitions("task", "side")
        .select("task", "side", "doc_id", "label", "shingles")
    )
    return ready.mapInArrow(over, "a bigint, b bigint")


def _frequencies(sets: DataFrame) -> np.ndarray:
    """About how many sets hold a shingle, by ``COUNTERS`` of its hash.

    A table of fixed size: which order shingles have is of no matter for the result, only
    that all sets see the same.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for packed in batch.column("shingles"):
                at = np.frombuffer(packed.as_py(), dtype=np.uint64) & np.uint64(COUNTERS - 1)
                np.add.at(counts, at.astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    found = sets.select("shingles").mapInArrow(over, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, dtype=np.int64)
    counts[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return counts


def prefixes(shingles: np.ndarray, counts: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, int]:
    """The rarest shingles of a set, and how many of them also count as the short prefix.

    Of two sets at the threshold, the short prefix of the one that is not larger and the
    prefix of the other have a shingle in common.
    """
    n = len(shingles)
    long = n - -(-threshold * n // 100) + 1
    short = n - -(-2 * threshold * n // (100 + threshold)) + 1
    order = np.lexsort((shingles, counts[(shingles & np.uint64(COUNTERS - 1)).astype(np.int64)]))
    return shingles[order[:long]], short


def possible(members: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id of the members (doc_id, label) that could have a partner of another label."""
    held = checkpointed(members.join(sets, "doc_id"))
    counts = held.sparkSession.sparkContext.broadcast(_frequencies(held))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, sizes, short = [np.zeros(0, np.uint64)], [], [np.zeros(0, bool)]
            for packed in batch.column("shingles"):
                found, n = prefixes(np.frombuffer(packed.as_py(), dtype=np.uint64), counts.value, threshold)
                parts.append(found)
                sizes.append(len(found))
                short.append(np.arange(len(found)) < n)
            at = pa.array(np.repeat(np.arange(batch.num_rows), np.array(sizes, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at), batch.column("label").take(at),
                    pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.concatenate(short)),
                ],
                names=["doc_id", "label", "g", "short"],
            )

    rows = held.mapInArrow(over, "doc_id bigint, label bigint, g bigint, short boolean")
    met = rows.groupBy("g").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.bool_or("short").alias("short")
    )
    return rows.join(met.where("lo < hi AND short"), "g", "left_semi").select("doc_id").distinct()


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept."""
    sketches = checkpointed(sketch(docs))

    key = ["n_shingles", "h1", "h2"]
    usable = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy(*key).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    # Only classes of several rows are joined back; the hot ones are what skew handling splits.
    classed = checkpointed(
        sketches.select("doc_id", *key)
        .join(classes.where("n > 1").drop("n"), key, "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("class_id"),
        )
    )
    single = usable.join(
        classed.where("doc_id = class_id").select("doc_id").distinct(), "doc_id", "left_semi"
    )
    members = single.select("doc_id", F.explode("bands").alias("band"))
    hubs = members.groupBy("band").agg(
        F.min("doc_id").alias("hub"), F.max("doc_id").alias("last"), F.count("*").alias("n")
    )
    groups = checkpointed(members.join(hubs.where("hub < last").drop("last"), "band"))

    sets = checkpointed(full_sets(docs, groups.select("doc_id").distinct()))
    star = groups.where("hub < doc_id").select("hub", "doc_id").distinct()
    sizes = star.groupBy("hub").agg(_chunks(F.count("*"), RIGHT).alias("chunks"))
    chunk = F.pmod(F.xxhash64("doc_id"), "chunks")
    right = star.join(sizes, "hub").select(
        F.xxhash64("hub", chunk).alias("task"), F.lit(1).alias("side"), "doc_id", F.col("doc_id").alias("label")
    )
    left = sizes.select("hub", F.explode(_numbers("chunks")).alias("chunk")).select(
        F.xxhash64("hub", "chunk").alias("task"), F.lit(0).alias("side"), F.col("hub").alias("doc_id"), F.col("hub").alias("label")
    )
    first = checkpointed(confirm(left.union(right), sets, threshold))
    labels = components(first)

    # Groups that reach into several components: all pairs across, in chunks.
    placed = (
        groups.select("band", "doc_id")
        .join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("band", "doc_id", F.coalesce("label", "doc_id").alias("label"))
        .distinct()
    )
    several = placed.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    in_doubt = checkpointed(placed.join(several.select("band"), "band", "left_semi"))
    able = possible(in_doubt.select("doc_id", "label").distinct(), sets, threshold)
    sized = classed.where("doc_id = class_id").select("doc_id", "n_shingles").distinct()
    placed = checkpointed(in_doubt.join(able, "doc_id", "left_semi").join(sized, "doc_id"))
    shares = placed.groupBy("band", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    mixed = (
        shares.groupBy("band")
        .agg(F.max(F.struct("n", "label", "size")).alias("most"), F.sum("n").alias("n"), F.sum("size").alias("size"))
        .where("most.n < n")
        .select(
            "band",
            F.col("most.label").alias("major"),
            F.greatest(
                _chunks(F.col("n") - F.col("most.n"), LEFT), _chunks(F.col("size") - F.col("most.size"), LEFT_SHINGLES)
            ).alias("lefts"),
            _chunks(F.col("n"), RIGHT).alias("rights"),
        )
    )
    across = placed.drop("n_shingles").join(mixed, "band")
    hashed = F.xxhash64("doc_id")
    left = across.where("label <> major").select(
        "band", F.pmod(hashed, "lefts").alias("i"), F.explode(_numbers("rights")).alias("j"),
        F.lit(0).alias("side"), "doc_id", "label",
    )
    right = across.select(
        "band", F.explode(_numbers("lefts")).alias("i"), F.pmod(hashed, "rights").alias("j"),
        F.lit(1).alias("side"), "doc_id", "label",
    )
    tasks = left.union(right).select(F.xxhash64("band", "i", "j").alias("task"), "side", "doc_id", "label")
    labels = components(first.union(confirm(tasks, sets, threshold)))

    component = F.coalesce("label", "class_id")
    return classed.join(labels.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _chunks(size: Column, most: int) -> Column:
    """Into how many chunks of about ``most`` a group is cut."""
    return F.ceil(size / most).cast("bigint")


def _numbers(count: str) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1)


def deduplicate(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest id of each component.

    Rows that repeat one id stay together.
    """
    kept = near_duplicates(docs, threshold)
    gone = kept.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
