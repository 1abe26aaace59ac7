"""Connected components of a graph of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetable.llm.tables import settled


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label``, the smallest id reachable, for every id in ``links`` (a, b).

    Each round takes the smallest label among the neighbours, then the label of the
    label, so chains shorten by more than half.  A round is written to the
    shared folder; only the number of changes comes to the driver.  The minimum is
    taken in every task before the shuffle, so a hot id costs one row per task there.
    """
    edges = settled(
        links.select("a", "b")
        .union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b")
        .distinct()
    )
    labels = edges.groupBy("a").agg(F.min("b").alias("m"))
    labels = settled(labels.select(F.col("a").alias("id"), F.least("a", "m").alias("label")))
    while True:
        near = (
            edges.join(labels.select(F.col("id").alias("b"), "label"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, labels["id"] == near["a"]).select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("new")
        )
        jump = labels.select(F.col("id").alias("new"), F.col("label").alias("far"))
        moved = settled(step.join(jump, "new").select("id", "old", F.least("new", "far").alias("label")))
        labels = moved.select("id", "label")
        if moved.where("old <> label").isEmpty():
            return labels
