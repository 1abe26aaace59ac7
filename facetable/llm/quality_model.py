"""A quality classifier: boosted trees over statistics of whole texts.

Trees are fitted on a bounded sample of labelled documents (``SAMPLE``, chosen by a
hash of the id, so the choice does not depend on order or partitions) that are not
held out.  The forest, some tens of kilobytes, travels with the function that
scores Arrow batches.  Scoring is row by row: nothing is shuffled.

Only the text is an input.  The statistics describe shape (lengths, classes of
characters, repeated words and lines), so no word list is learned.

Edge cases: a NULL text counts as empty; an empty one is scored like any other, by
its statistics of zero.  Without usable labels every score is one half.  Labels of
NULL ids, NULL labels and ids with labels that disagree evenly are not learned from.
Repeated rows get equal scores.  Columns of the same name as a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetable.llm import boosting
from facetable.llm.tables import held_out

#: Labelled documents the trees are fitted on, at most.
SAMPLE = 12_000
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "log_lines", "bytes_per_word", "words_per_line", "upper",
    "digit", "punct", "symbol", "stop", "exclaim", "high", "space", "distinct_words",
    "top_word", "distinct_lines", "distinct_pairs", "capital_words", "marked_words",
)

#: Class of each byte: 0 lower, 1 upper, 2 digit, 3 other punctuation, 4 symbol,
#: 5 full stop or comma, 6 exclamation or question mark, 7 beyond ASCII, 8 white space.
CLASS = np.full(256, 3, dtype=np.uint8)
CLASS[128:] = 7
CLASS[ord("a") : ord("z") + 1] = 0
CLASS[ord("A") : ord("Z") + 1] = 1
CLASS[ord("0") : ord("9") + 1] = 2
CLASS[list(b"#*$%&|<>=@^~_\\{}[]")] = 4
CLASS[list(b".,;:")] = 5
CLASS[list(b"!?")] = 6
CLASS[[9, 10, 11, 12, 13, 32]] = 8


def statistics(text: str | None) -> list[float]:
    """The features of one whole text."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    share = np.bincount(CLASS[data], minlength=9) / max(len(data), 1)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n, n_lines = max(len(words), 1), max(len(lines), 1)
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(lines)),
        len(data) / n, len(words) / n_lines, *share[1:9],
        len(counts) / n, max(counts.values(), default=0) / n,
        len(set(lines)) / n_lines, pairs / n,
        sum(map(str.isupper, counts)) / max(len(counts), 1),
        sum(not w[-1].isalnum() for w in counts) / max(len(counts), 1),
    ]


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, sample: int = SAMPLE) -> boosting.Forest:
    """Trees from labelled documents outside the held-out fold."""
    spark = docs.sparkSession
    agreed = (
        labels.where(
            F.col("doc_id").isNotNull()
            & ~held_out(F.col("doc_id"), folds, fold)
            & F.col("quality").isNotNull()
        )
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("mean"))
        .where(F.col("mean") != 0.5)
        .select("doc_id", (F.col("mean") > 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # Bounded by ``sample``; the plan sees it as a list of ids and labels.
    chosen = spark.createDataFrame(agreed.collect(), "doc_id bigint, label int")
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("label", T.IntegerType()),
            *[T.StructField(f, T.DoubleType()) for f in FEATURES],
        ]
    )

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([statistics(t) for t in batch["text"]], columns=list(FEATURES))
            rows.insert(0, "label", batch["label"].to_numpy())
            rows.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield rows

    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    # Rows that repeat an id are one document, so ``sample`` bounds what reaches the driver.
    measured = texts.select("doc_id", "label", "text").mapInPandas(measure, schema)
    one = measured.groupBy("doc_id").agg(F.min(F.struct("label", *FEATURES)).alias("row"))
    rows = one.select("row.*").toPandas().to_numpy()
    rows = rows[np.lexsort(rows.T)]  # the order of rows must not change sums
    return boosting.train(rows[:, 1:], rows[:, 0])


def score(docs: DataFrame, forest: boosting.Forest, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better) and ``predicted``."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType(
        [
            *[docs.schema[c] for c in kept],
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = np.array([statistics(t) for t in batch[text_col]]).reshape(-1, len(FEATURES))
            p = forest.score(rows)
            yield batch[kept].assign(score=p, predicted=(p >= threshold).astype(np.int32))

    return docs.mapInPandas(over, schema)
