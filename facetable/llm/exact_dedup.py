"""Exact duplicates by a tree-merge of digest runs.

Rows are dealt into ``FAN ** ROUNDS`` slices by a hash of their id, so a text that a
third of all rows hold is spread over all slices.

* Runs: each slice is reduced to one entry per text: the digest, the identifier that
  stays and the number of rows.  Spark combines within every task before it sends.  These
  runs are written to the shared folder.
* Rounds: ``FAN`` neighbouring runs are merged into one, entry by entry, until one run
  is left.  No entry of a round gathers more than ``FAN`` entries, however often its
  text occurs.  A run is a set of entries, dealt to tasks by digest, never one task.
* The way back: the answer of a merged run goes to the runs it was made of, and from the
  first runs to the rows, so the rows of a frequent text meet their answer slice by
  slice.

Texts are compared by SHA-256; at every level the length and a second hash must agree as
well before two entries are merged, so an identifier is passed on only if all three do.
Main path: DataFrame functions alone.

Edge cases: a NULL text counts as empty; nothing else is changed before the comparison,
so texts that differ in case, white space or Unicode form are different.  Of equal texts
the row with the largest (or smallest) id stays; rows that repeat that id and the text
stay together.  A NULL id is never the one that stays, unless no row of the text has an
id; then these rows stay.  An empty table gives no rows.  Other columns pass through,
those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetable.llm.tables import settled, unused

#: Runs that one round merges into one, and rounds: 4096 slices.
FAN = 16
ROUNDS = 3

RESULTS = ("keep_id", "group_size", "kept", "text_sha256")


def merge_round(runs: DataFrame, keep: Column, fan: int = FAN) -> DataFrame:
    """Merge ``fan`` neighbouring runs; ``runs`` has (run, digest, bytes, check, keep, rows)."""
    return runs.groupBy(
        F.floor(F.col("run") / fan).cast("int").alias("run"), "digest", "bytes", "check"
    ).agg(keep.alias("keep"), F.sum("rows").alias("rows"))


def hand_down(merged: DataFrame, runs: DataFrame, fan: int = FAN) -> DataFrame:
    """The answers of merged runs for the entries of the runs they were made of."""
    answers = merged.select(F.col("run").alias("parent"), "digest", "bytes", "check", "keep", "rows")
    own = runs.select("run", "digest", "bytes", "check", F.floor(F.col("run") / fan).cast("int").alias("parent"))
    return own.join(answers, ["parent", "digest", "bytes", "check"]).drop("parent")


def mark(
    docs: DataFrame,
    keep: str = "largest",
    id_col: str = "doc_id",
    text_col: str = "text",
    fan: int = FAN,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``docs`` with ``keep_id`` (of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256``.  ``keep`` is "largest" or "smallest".

    Columns of ``docs`` that the caller does not select afterwards are not shuffled.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep!r}")
    best = F.max if keep == "largest" else F.min
    docs = docs.select([c for c in docs.columns if c not in RESULTS])
    run, digest, size, check = unused([*docs.columns, *RESULTS, "keep", "rows"], "run", "digest", "bytes", "check")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        "*",
        F.pmod(F.xxhash64(id_col), F.lit(fan**rounds)).cast("int").alias(run),
        F.unhex(F.sha2(text, 256)).alias(digest),
        F.octet_length(text).alias(size),
        F.xxhash64(text).alias(check),
    )
    key = ["run", "digest", "bytes", "check"]
    first = rows.select(
        *[F.col(c).alias(name) for c, name in zip((run, digest, size, check), key, strict=True)],
        F.col(id_col).alias("keep"),
    )
    # Written, because every round below starts from them; the texts are not read for it again.
    levels = [settled(first.groupBy(*key).agg(best("keep").alias("keep"), F.count("*").alias("rows")))]
    for _ in range(rounds):
        levels.append(merge_round(levels[-1], best("keep"), fan))
    answers = levels.pop()
    while levels:
        answers = hand_down(answers, levels.pop(), fan)
    answers = answers.select(
        *[F.col(name).alias(c) for c, name in zip((run, digest, size, check), key, strict=True)],
        F.col("keep").alias("keep_id"),
        F.col("rows").alias("group_size"),
    )
    return rows.join(answers, [run, digest, size, check]).select(
        *docs.columns,
        "keep_id",
        "group_size",
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex(digest)).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    own = [c for c in docs.columns if c in RESULTS]
    if own:
        raise ValueError(f"columns are named like a result: {own}")
    return mark(docs, keep, id_col, text_col).where("kept").select(*docs.columns)
