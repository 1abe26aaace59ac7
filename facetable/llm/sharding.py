"""A uniform shuffle into shards of exact size, by a hypergeometric matrix.

Shuffling rows uniformly over bins of fixed size is the same as three steps:

1. draw how many rows of each block go to each bin.  Given the number of rows per
   block, the counts of a uniform shuffle follow a multivariate hypergeometric law,
   drawn row by row; the sums per bin are exact by construction;
2. permute within each block, so that *which* rows fill the drawn counts is uniform;
3. exchange, and permute again within each bin.

Each shard is cut into bins of consecutive slots, so no task ever holds a shard.
A block is a hash of a row's whole content, not a physical partition: a lost and
recomputed task finds the same rows in the same block.  There is a block, and a bin, for
about ``ROWS_EACH`` rows, ``MOST`` at most; only the counts per block reach the driver, and
the matrix has ``MOST ** 2`` entries at most (32 MB), whatever the data.  The draws have the
same law at any number of rows.

A hot source or a group of equal texts spreads over all blocks, because the ids differ.
Rows equal in every column are exchangeable.  Where so many are equal that they would fill
a tenth of a block, they are written to the shared folder with a number and a block each,
dealt in turn, so that the counts and the deal see the same.  Fewer equal rows share a
block and lie side by side there before the deal, so they tend to the same shards.

Edge cases: NULL in any column is a value like any other; MAP columns count as their
JSON; an empty table gives no row; shards may be empty when there are fewer rows than
shards.  Other columns pass through; columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetable.llm.tables import settled

#: Rows of a block or bin; and how many there are at least and at most.
ROWS_EACH = 1_000_000
LEAST, MOST = 64, 2048


def bin_sizes(n: int, shards: int, bins: int) -> np.ndarray:
    """Rows per bin, shard by shard: shards differ by one row at most, and so do the
    bins of one shard."""
    per_shard = np.full(shards, n // shards, dtype=np.int64)
    per_shard[: n % shards] += 1
    sizes = np.repeat(per_shard[:, None] // bins, bins, axis=1)
    sizes += np.arange(bins) < (per_shard % bins)[:, None]
    return sizes.ravel()


def draw_matrix(blocks: np.ndarray, bins: np.ndarray, seed: int) -> np.ndarray:
    """Rows of each block that go to each bin, as a uniform shuffle would deal them."""
    rng = np.random.default_rng(seed)
    left, matrix = bins.copy(), np.zeros((len(blocks), len(bins)), dtype=np.int64)
    for k, n in enumerate(blocks):
        matrix[k] = _draw(rng, left, int(n))
        left -= matrix[k]
    return matrix


def _draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """One multivariate hypergeometric row by halves; numpy draws it in one call only
    for at most 10^9 rows in all."""
    if len(left) == 1:
        return np.array([n], dtype=np.int64)
    half = len(left) // 2
    good, bad = int(left[:half].sum()), int(left[half:].sum())
    first = _hypergeometric(rng, good, bad, n)
    return np.concatenate([_draw(rng, left[:half], first), _draw(rng, left[half:], n - first)])


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if max(good, bad) < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    return _inverted(rng, good, bad, n)


def _inverted(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """The same law for populations of any size, by inversion around the mode.

    Probabilities follow from their neighbours by exact ratios, out to where they are
    below the resolution of a double.
    """
    total = good + bad
    mean = n * good / total
    spread = np.sqrt(max(mean * (bad / total) * ((total - n) / max(total - 1, 1)), 0.0))
    low, high = max(0, n - bad), min(good, n)
    mode = min(max((good + 1) * (n + 1) // (total + 2), low), high)
    reach = int(12 * spread) + 40
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    ratio = (good - k) / (k + 1) * ((n - k) / (bad - n + k + 1))  # of k + 1 to k
    up = np.cumprod(ratio[mode - first :])
    down = np.cumprod(1 / ratio[: mode - first][::-1])[::-1]
    summed = np.cumsum(np.concatenate([down, [1.0], up]))
    return min(first + int(np.searchsorted(summed, rng.random() * summed[-1], "right")), last)


def parts_for(n: int) -> int:
    """How many blocks, or bins, so many rows are cut into."""
    return min(max(-(-n // ROWS_EACH), LEAST), MOST)


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and has_map(kind.elementType))


def dealt_repeats(keyed: DataFrame, n: int, blocks: int) -> DataFrame:
    """``keyed`` with ``block``: by the key, but in turn for rows that are repeated often."""
    many = max(n // (10 * blocks), 1)
    repeated = keyed.groupBy("key", "check").count().where(F.col("count") > many).select("key", "check")
    by_key = keyed.withColumn("block", F.pmod("key", F.lit(blocks)).cast("int"))
    if repeated.isEmpty():
        return by_key
    repeated = settled(repeated)  # fewer than 10 * blocks keys
    in_turn = keyed.join(F.broadcast(repeated), ["key", "check"], "left_semi")
    # Every task begins at a block of its own; the number tells equal rows apart.
    numbered = in_turn.withColumn("number", F.monotonically_increasing_id() + F.spark_partition_id() * 7)
    in_turn = settled(
        numbered.select(
            "row", F.xxhash64("key", "number").alias("key"), "check",
            F.pmod("number", F.lit(blocks)).cast("int").alias("block"),
        )
    )
    others = by_key.join(F.broadcast(repeated), ["key", "check"], "left_anti")
    return others.unionByName(in_turn)


def shuffle_into_shards(
    rows: DataFrame,
    shards: int = 8,
    seed: int = 0,
    blocks: int | None = None,
    bins: int | None = None,
) -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    Without ``blocks`` and ``bins`` (per shard) there are as many as the rows need.
    """
    rows = rows.select(*[c for c in rows.columns if c not in ("shard", "slot")])
    columns = [F.col(f"`{c}`") for c in rows.columns]
    hashed = [
        F.to_json(F.struct(c)) if has_map(f.dataType) else c for c, f in zip(columns, rows.schema, strict=True)
    ]
    keyed = rows.select(
        F.struct(*columns).alias("row"),  # so that no name of theirs meets one used here
        F.xxhash64(F.lit(seed), *hashed).alias("key"),
        F.xxhash64(F.lit(seed), F.lit("check"), *hashed).alias("check"),
    )
    n = rows.count()
    blocks = blocks or parts_for(n)
    bins = bins or -(-parts_for(n) // shards)
    keyed = dealt_repeats(keyed, n, blocks)

    spark = rows.sparkSession
    counts = dict(keyed.groupBy("block").count().collect())
    sizes = bin_sizes(sum(counts.values()), shards, bins)
    matrix = draw_matrix(np.array([counts.get(b, 0) for b in range(blocks)]), sizes, seed)
    starts = (np.cumsum(sizes.reshape(shards, bins), axis=1) - sizes.reshape(shards, bins)).ravel()
    # One row per block: at most blocks * shards * bins numbers, whatever the data.
    ends = np.cumsum(matrix, axis=1)
    lists = pa.ListArray.from_arrays(np.arange(blocks + 1, dtype=np.int32) * (shards * bins), ends.ravel())
    dealt = spark.createDataFrame(pa.table({"block": pa.array(np.arange(blocks, dtype=np.int32)), "ends": lists}))
    first = Window.partitionBy("block").orderBy(F.xxhash64("key", F.lit(1)), "key", "check")
    placed = (
        keyed.withColumn("at", F.row_number().over(first) - 1)
        .join(F.broadcast(dealt), "block")
        .withColumn("bin", F.size(F.filter("ends", lambda end: end <= F.col("at"))))
        .drop("ends", "at", "block")
    )
    second = Window.partitionBy("bin").orderBy(F.xxhash64("key", F.lit(2)), "key", "check")
    start = F.get(F.lit(starts.tolist()).cast("array<bigint>"), F.col("bin"))
    return placed.select(
        "row.*",
        (F.col("bin") / bins).cast("int").alias("shard"),
        (start + F.row_number().over(second) - 1).alias("slot"),
    )
