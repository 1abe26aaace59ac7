"""Histogram gradient boosting for a yes-or-no label, in numpy.

Features are cut into at most 255 bins by quantiles; each tree grows level by level
from histograms of gradients, and all trees end as flat arrays, so a batch of rows
descends them together.  ``train`` takes a bounded sample, so it runs where the query
is planned; ``train_over`` takes a table of any size, of which only histograms reach the
driver, one for each level of a tree.  The arrays are a few kilobytes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetable.llm.tables import settled

#: What a row of weight one counts in tables for ``train_over``.
UNIT = 2**30


@dataclass
class Forest:
    """Full binary trees of one depth: node k has children 2k+1 and 2k+2.

    ``feature`` and ``threshold`` are (trees, inner nodes); a row goes right if its
    value is greater than the threshold.  ``leaf`` is (trees, leaves).
    """

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    @property
    def depth(self) -> int:
        return int(np.log2(self.leaf.shape[1]))

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        n, out = np.arange(len(rows)), np.full(len(rows), self.start)
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (rows[n, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows), -40, 40)))


def bin_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values, at quantiles where there are many."""
    distinct = np.unique(values)
    if len(distinct) > bins:
        distinct = np.unique(np.quantile(values, np.linspace(0, 1, bins), method="nearest"))
    return (distinct[:-1] + distinct[1:]) / 2


def best_splits(
    g: np.ndarray, h: np.ndarray, cuts: np.ndarray, smooth: float, least: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each node is split, by which feature and after which bin, from the sums of
    first and second derivatives by node, feature and bin."""
    n, _, width = g.shape
    gl, hl = g.cumsum(2), h.cumsum(2)
    gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
    gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
    gain[(hl < least) | (ht - hl < least) | ~np.isfinite(cuts)] = 0
    best = gain.reshape(n, -1).argmax(1)
    split = gain.reshape(n, -1)[np.arange(n), best] > 1e-9
    return split, best // width, best % width


def cut_points(edges: list[np.ndarray]) -> np.ndarray:
    """The edges as one array (features, bins), infinite where a feature has no more."""
    cuts = np.full((len(edges), max([1, *(len(e) + 1 for e in edges)])), np.inf)
    for f, e in enumerate(edges):
        cuts[f, : len(e)] = e
    return cuts


def train(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    smooth: float = 1.0,
    least: float = 1.0,
) -> Forest:
    """Fit to ``rows`` (n, features) and ``labels`` (0 or 1).

    ``smooth`` is the L2 penalty on leaves, ``least`` the sum of second derivatives
    either side of a split must reach.  Without rows, or with one label only, the
    forest answers with the smoothed share of ones.
    """
    labels = labels.astype(np.float64)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    features = rows.shape[1]
    one_sided = len(labels) == 0 or labels.min() == labels.max()
    edges = [bin_edges(rows[:, f], bins) if len(rows) else np.zeros(0) for f in range(features)]
    codes = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], axis=1)
    cuts = cut_points(edges)
    width = cuts.shape[1]

    out_f = np.zeros((0 if one_sided else trees, inner), dtype=np.int64)
    out_t = np.full(out_f.shape, np.inf)
    out_l = np.zeros((len(out_f), leaves))
    raw = np.full(len(labels), start)
    place = np.arange(features) * width
    for tree in range(len(out_f)):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = labels - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(labels), dtype=np.int64)
        for level in range(depth):
            base, n = 2**level - 1, 2**level
            at = ((node - base)[:, None] * (features * width) + place + codes).ravel()
            size = n * features * width
            g = np.bincount(at, np.repeat(grad, features), size).reshape(n, features, width)
            h = np.bincount(at, np.repeat(hess, features), size).reshape(n, features, width)
            split, f, b = best_splits(g, h, cuts, smooth, least)
            out_f[tree, base : base + n] = np.where(split, f, 0)
            out_t[tree, base : base + n] = np.where(split, cuts[f, b], np.inf)
            here = node - base
            right = split[here] & (codes[np.arange(len(node)), f[here]] > b[here])
            node = 2 * node + 1 + right
        leaf = node - inner
        total_g, total_h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        out_l[tree] = rate * total_g / (total_h + smooth)
        raw += out_l[tree][leaf]
    return Forest(out_f, out_t, out_l, start)


def edges_over(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """``bin_edges`` of every feature of a table with ``x`` and ``units``.

    The values of a feature are counted before they are put in order, so what a task
    sorts is the different values of one feature.
    """
    counted = (
        rows.select(F.posexplode("x").alias("feature", "value"), "units")
        .groupBy("feature", "value")
        .agg(F.sum("units").alias("units"))
    )
    of_feature = Window.partitionBy("feature")
    summed = counted.select(
        "feature", "value", "units",
        F.count("*").over(of_feature).alias("distinct"),
        F.sum("units").over(of_feature).alias("total"),
        F.sum("units").over(of_feature.orderBy("value")).alias("upto"),
    )

    def falls_here(j: Column) -> Column:
        at = F.round(j * (F.col("total") / UNIT - 1) / (bins - 1)) * UNIT
        return (at >= F.col("upto") - F.col("units")) & (at < F.col("upto"))

    quantile = F.exists(F.sequence(F.lit(0), F.lit(bins - 1)), falls_here)
    kept = summed.where((F.col("distinct") <= bins) | quantile).select("feature", "value").collect()  # ``bins`` a feature
    values = [np.array(sorted(r["value"] for r in kept if r["feature"] == f)) for f in range(features)]
    return [(v[:-1] + v[1:]) / 2 for v in values]


def train_over(
    rows: DataFrame,
    features: int,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    smooth: float = 1.0,
    least: float = 1.0,
) -> Forest:
    """``train`` on all rows of a table with ``x`` (array of doubles), ``y`` (boolean) and
    ``units`` (the row's weight times ``UNIT``, a whole number).

    Rows of equal bins and label become one, which keep the log odds of the trees so far;
    every level of a tree is one pass that sums derivatives by node, feature and bin.  The
    sums are of whole numbers, so neither order nor partitions change a tree.
    """
    share_of = rows.groupBy("y").agg(F.sum("units").alias("units")).collect()
    weight = {r["y"]: r["units"] / UNIT for r in share_of}
    total = sum(weight.values())
    share = (weight.get(True, 0.0) + 0.5) / (total + 1)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(weight) < 2:
        return Forest(np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    edges = edges_over(rows, features, bins)
    cuts = cut_points(edges)
    width = cuts.shape[1]
    # Whole numbers that stay exact as doubles when all are summed.
    scale = 2.0 ** min(32, 52 - int(np.ceil(np.log2(total + 1))))
    doubles = F.array().cast("array<double>")
    cut_at = F.array(*[F.concat(doubles, F.array(*map(F.lit, e.tolist()))) for e in edges])
    code = F.zip_with("x", cut_at, lambda v, cut: F.size(F.filter(cut, lambda c: c < v)))
    table = rows.select(code.alias("code"), "y", "units").groupBy("code", "y").agg(F.sum("units").alias("units"))
    table = settled(table.withColumn("raw", F.lit(start)))

    out_f = np.zeros((trees, inner), dtype=np.int64)
    out_b = np.full(out_f.shape, width)  # a bin no row is beyond
    out_l = np.zeros((trees, leaves))

    def down(tree: int, until: int, end: Callable[[int], Column], k: int = 0) -> Column:
        """``end`` of the node where a row stands, from ``until`` on."""
        if k >= until:
            return end(k)
        left = down(tree, until, end, 2 * k + 1)
        if out_b[tree, k] == width:
            return left
        right = F.get("code", F.lit(int(out_f[tree, k]))) > int(out_b[tree, k])
        return F.when(right, down(tree, until, end, 2 * k + 2)).otherwise(left)

    for tree in range(trees):
        if tree:
            grown = down(tree - 1, inner, lambda k: F.lit(float(out_l[tree - 1, k - inner])))
            table = table.withColumn("raw", F.col("raw") + grown)
        p = 1 / (1 + F.exp(-F.col("raw")))
        weight_of = F.col("units") / UNIT * scale
        grad = F.rint((F.col("y").cast("double") - p) * weight_of).cast("long")
        hess = F.rint(F.greatest(p * (1 - p), F.lit(1e-6)) * weight_of).cast("long")
        table = settled(table.select("code", "y", "units", "raw", grad.alias("g"), hess.alias("h")))
        for level in range(depth):
            base, n = 2**level - 1, 2**level
            node = down(tree, base, lambda k: F.lit(k - base))
            summed = (
                table.select(node.alias("node"), F.posexplode("code").alias("feature", "bin"), "g", "h")
                .groupBy("node", "feature", "bin")
                .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
                .toArrow()  # at most nodes * features * bins
            )
            at = tuple(summed[c].to_numpy() for c in ("node", "feature", "bin"))
            g, h = np.zeros((n, features, width)), np.zeros((n, features, width))
            g[at], h[at] = summed["g"].to_numpy() / scale, summed["h"].to_numpy() / scale
            split, f, b = best_splits(g, h, cuts, smooth, least)
            out_f[tree, base : base + n] = np.where(split, f, 0)
            out_b[tree, base : base + n] = np.where(split, b, width)
        # The leaves' sums are those either side of the last splits.
        here = np.arange(n)
        left_g, left_h = g[here, f].cumsum(1)[here, b], h[here, f].cumsum(1)[here, b]
        all_g, all_h = g[:, 0].sum(1), h[:, 0].sum(1)
        left_g, left_h = np.where(split, left_g, all_g), np.where(split, left_h, all_h)
        sums_g, sums_h = np.stack([left_g, all_g - left_g], 1).ravel(), np.stack([left_h, all_h - left_h], 1).ravel()
        out_l[tree] = rate * sums_g / (sums_h + smooth)
    out_t = np.append(cuts, np.full((features, 1), np.inf), axis=1)[out_f, out_b]
    return Forest(out_f, out_t, out_l, start)
