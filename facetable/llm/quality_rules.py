"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one integer whose set bits are the rules that failed.  A policy is a named,
versioned set of rules, so applying it is one AND with its mask, and an ablation
(how many more documents pass without this rule) needs no second look at the
texts: it is computed from the number of documents per failure mask.

Only DataFrame functions are used.  All measurements are taken within the row, so
nothing is shuffled and a hot source or a group of copies needs no care.

Edge cases: a NULL text has no words and fails ``few_words``; the same for an
empty one.  Repeated rows and NULL ids are judged like any other row.  Other
columns pass through ``ledger`` unless they have the name of a measurement, in
which case they are replaced.  A word window is compared by a 64-bit hash of the
64-bit hashes of its eight words, within one document only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetable.llm.tables import fixed, words_of

WINDOW = 8

#: Rule name -> condition on the measurements under which a document fails.
#: The position of a rule is its bit; append new rules, never reorder.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "long_words": "word_chars > 20 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "exclaiming": "5 * n_exclaim > n_words",
    "broken_lines": "n_lines >= 3 AND 100 * n_cut_lines > 50 * n_lines",
}

BASE = ("few_words", "repeated_words")

#: Policy version -> the rules it applies.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": tuple(RULES),
}

MEASUREMENTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_exclaim", "n_cut_lines",
)


def mask(rules: Sequence[str]) -> int:
    """The bits of some rules."""
    order = list(RULES)
    return sum(1 << order.index(rule) for rule in set(rules))


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more.

    ``hashes`` is in order of position.  Sorting (hash, position) puts equal windows
    side by side; their positions, sorted again, are swept once.
    """
    placed = F.sort_array(
        F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    )

    def twice(item: Column, i: Column, all_items: Column) -> Column:
        before = F.get(all_items, i - 1)["h"]
        after = F.get(all_items, i + 1)["h"]
        same = F.coalesce(before == item["h"], F.lit(False)) | F.coalesce(
            after == item["h"], F.lit(False)
        )
        return F.when(same, item["p"])

    # One-element array: binds the sorted list to a name, so it is sorted once.
    marked = F.flatten(
        F.transform(
            F.array(placed),
            lambda items: F.array_compact(F.transform(items, lambda x, i: twice(x, i, items))),
        )
    )
    swept = F.aggregate(
        F.sort_array(marked),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda seen, p: F.struct(
            (seen["n"] + p + WINDOW - F.greatest(seen["end"], p)).alias("n"),
            (p + WINDOW).alias("end"),
        ),
    )
    return swept["n"]


def _count(text: Column, characters: str) -> Column:
    """How many of some characters a text has; byte-wise, so without a pattern."""
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.length(text) - F.length(rest)


def _window_hashes(word_hash: Column, n: Column) -> Column:
    """A hash per window of eight words: pairs, then fours, then eights."""
    hashes = word_hash
    for step in (1, 2, 4):
        ahead = F.slice(hashes, step + 1, F.greatest(n - step, F.lit(0)))
        hashes = F.zip_with(hashes, ahead, lambda a, b: F.xxhash64(a, b))
    return F.slice(hashes, 1, n - WINDOW + 1)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements the rules need, all of them BIGINT."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [c for c in docs.columns if c not in MEASUREMENTS]
    split = docs.select(
        F.struct(*kept).alias("row"),  # so that no name of theirs meets one used here
        text.alias("text"),
        words_of(F.col(text_col)).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n, text = F.size("words"), F.col("text")
    hashed = split.select(
        "row",
        n.alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        _count(text, "#*$%&|<>").alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _count(text, "!").alias("n_exclaim"),
        F.size(
            F.filter("lines", lambda x: F.endswith(x, F.lit("...")) | F.endswith(x, F.lit("…")))
        ).alias("n_cut_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("word_hash"),
    )
    windows = hashed.withColumn(
        "windows",
        F.when(
            F.col("n_words") >= WINDOW, _window_hashes(F.col("word_hash"), F.col("n_words"))
        ),
    )
    repeats = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"), _repeat_words(F.col("windows"))
    )
    measured = windows.withColumn("n_repeat_words", F.coalesce(repeats, F.lit(0)))
    return measured.select("row.*", *[F.col(m).cast("long").alias(m) for m in MEASUREMENTS])


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failed``, the bits of the failed rules."""
    bits = [
        F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")
        for bit, condition in enumerate(RULES.values())
    ]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, text_col).withColumn("failed", fixed(failed))


def fails(policy: str) -> Column:
    """Whether a row of the ledger fails a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) != 0


def apply_policy(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """The rows of a ledger that pass a policy."""
    return rows.where(~fails(policy))


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents that fail it, and that fail it alone.

    ``n_alone`` is how many more documents would pass without the rule.  Documents
    are first counted per mask (at most two to the number of rules rows), and only
    those counts are compared with each rule.
    """
    chosen = mask(POLICIES[policy])
    counts = rows.groupBy(F.col("failed").bitwiseAND(F.lit(chosen)).alias("bits")).agg(
        F.count("*").alias("n")
    )
    order = list(RULES)
    rules = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.lit(1 << order.index(r)).cast("long").alias("bit"))
            for r in POLICIES[policy]
        ]
    )
    each = counts.select("bits", "n", F.explode(rules).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_alone"),
    )
