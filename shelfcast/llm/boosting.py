"""Gradient-boosted trees for small fits: a bounded sample goes in, a few arrays come out and travel with the tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees: ``feature`` and ``cut`` by (tree, inner node), ``leaf`` by (tree, leaf)."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def fit_trees(x: np.ndarray, y: np.ndarray, *, rounds: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 2.0) -> Trees:
    """Logistic boosting with Newton leaves over histograms. Deterministic."""
    n, width = x.shape
    edges = [_edges(x[:, j], bins) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    most = max((len(e) for e in edges), default=0) + 1
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin, inner = np.full(n, base), 2**depth - 1
    features, cuts, leaves = [], [], []
    for _ in range(rounds if n else 0):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            slot = (at - first) * most
            gains = np.full((width, nodes, most), -np.inf)
            for j in range(width):
                g = np.bincount(slot + binned[:, j], gradient, nodes * most).reshape(nodes, most).cumsum(1)
                h = np.bincount(slot + binned[:, j], weight, nodes * most).reshape(nodes, most).cumsum(1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge) - whole_g**2 / (whole_h + ridge)
                gains[j, :, : len(edges[j])] = gain[:, : len(edges[j])]
            best = gains.transpose(1, 0, 2).reshape(nodes, -1).argmax(1)
            value = gains.transpose(1, 0, 2).reshape(nodes, -1).max(1)
            for node in np.flatnonzero(value > 1e-6):
                j, k = divmod(int(best[node]), most)
                feature[first + node], cut[first + node] = j, edges[j][k]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        leaf_of = at - inner
        g, h = np.bincount(leaf_of, gradient, inner + 1), np.bincount(leaf_of, weight, inner + 1)
        leaf = -rate * g / (h + ridge)
        margin += leaf[leaf_of]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    shape = (len(features), inner)
    return Trees(base, np.array(features, np.int64).reshape(shape), np.array(cuts, float).reshape(shape), np.array(leaves, float).reshape(len(leaves), inner + 1))
