"""Small gradient-boosted trees on numpy arrays, for models fitted on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    intercept: float = 0.0
    edges: list = field(default_factory=list)
    trees: list = field(default_factory=list)  # (features, bins, values) of a full binary tree

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.intercept)
        if len(x) and self.trees:
            binned = _binned(x, self.edges)
            for tree in self.trees:
                raw += _leaf_values(binned, tree)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _binned(x: np.ndarray, edges: list) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)


def _leaf_values(binned: np.ndarray, tree) -> np.ndarray:
    features, cuts, values = tree
    at = np.zeros(len(binned), np.int64)
    rows = np.arange(len(binned))
    while at.size and at[0] < len(features):  # all rows are on the same level
        at = 2 * at + 1 + (binned[rows, features[at]] >= cuts[at])
    return values[at - len(features)]


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 24) -> BoostedTrees:
    """Logistic boosting with full trees of ``depth`` levels. One class gives a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = BoostedTrees(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:])) for j in range(x.shape[1])]
    binned = _binned(x, model.edges)
    width = max(len(e) for e in model.edges) + 1
    raw = np.full(len(y), model.intercept)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        grad, hess = y - p, p * (1 - p)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, width)
        at = np.zeros(len(y), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = 1e-6
            g_all, h_all = grad[rows].sum(), hess[rows].sum()
            for j in range(x.shape[1]):
                g = np.cumsum(np.bincount(binned[rows, j], grad[rows], width))[:-1]
                h = np.cumsum(np.bincount(binned[rows, j], hess[rows], width))[:-1]
                gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, features[node], cuts[node] = gain[k], j, k + 1
            at[rows] = 2 * node + 1 + (binned[rows, features[node]] >= cuts[node])
        leaf = at - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        tree = (features, cuts, rate * g / (h + 1))
        model.trees.append(tree)
        raw += tree[2][leaf]
    return model
