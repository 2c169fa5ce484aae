"""Connected components of a link table, by smallest labels with pointer jumping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.store import saved


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``; label is the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours and then the label of that label, so that long
    chains shrink to half. A round's table is written down; nothing is collected. Neighbours are summed up before the
    shuffle, so a node with very many links costs no more than its rows.
    """
    both = saved(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "links")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        theirs = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        low = both.join(theirs, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("low"))
        nearer = labels.join(low, "node").select("node", F.least("label", "low").alias("next"), "label")
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved = nearer.join(jump, "next").select("node", F.least("next", "further").alias("label"), (F.least("next", "further") != F.col("label")).alias("moved"))
        moved = saved(moved, "labels")
        labels = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return labels


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(node, label)`` after further links between these nodes; only the components that links meet are worked on."""
    of = [labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")) for end in ("a", "b")]
    between = links.select("a", "b").join(of[0], "a").join(of[1], "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))
    roots = components(between).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return labels.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label"))


def forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of pairs that connect what those before leave apart."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    used = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            used.append(i)
    return used
