"""Histogram gradient-boosted trees for two classes, as flat arrays.

Features are cut to bins once; trees grow level by level from histograms of gradients
over the bins. A model is four arrays, one row per tree, in the layout of a complete
binary tree: node i has the children 2i + 1 and 2i + 2. Scoring walks all rows down a
tree at once, one level per step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    feature: np.ndarray  # (trees, nodes) feature to test
    threshold: np.ndarray  # (trees, nodes) rows at or below go left
    value: np.ndarray  # (trees, leaves)
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += value[at - inner]
        return 1.0 / (1.0 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, n_bins: int = 64,
    rate: float = 0.15, l2: float = 1.0, least_rows: int = 20,
) -> Trees:
    """Boost ``n_trees`` on the logistic loss. One class only, or no rows, gives a constant."""
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    bias = float(np.log(share / (1.0 - share)))
    if len(y) == 0 or y.min() == y.max():
        none = np.zeros((0, inner))
        return Trees(none.astype(np.int64), none, np.zeros((0, leaves)), bias)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, n_bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    n, n_features = x.shape
    features = np.zeros((n_trees, inner), dtype=np.int64)
    thresholds = np.full((n_trees, inner), np.inf)
    values = np.zeros((n_trees, leaves))
    raw = np.full(n, bias)
    for tree in range(n_trees):
        p = 1.0 / (1.0 + np.exp(-raw))
        gradient, hessian = y - p, p * (1.0 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gain = np.zeros((n_features, width))
            cut = np.zeros((n_features, width), dtype=np.int64)
            for f in range(n_features):
                cells = (node - first) * n_bins + binned[:, f]
                g, h, c = (
                    np.bincount(cells, w, minlength=width * n_bins).reshape(width, n_bins).cumsum(axis=1)
                    for w in (gradient, hessian, np.ones(n))
                )
                left = g[:, :-1] ** 2 / (h[:, :-1] + l2)
                right = (g[:, -1:] - g[:, :-1]) ** 2 / (h[:, -1:] - h[:, :-1] + l2)
                gained = left + right - g[:, -1:] ** 2 / (h[:, -1:] + l2)
                gained[(c[:, :-1] < least_rows) | (c[:, -1:] - c[:, :-1] < least_rows)] = 0.0
                gained[:, len(edges[f]):] = 0.0
                cut[f] = gained.argmax(axis=1)
                gain[f] = gained[np.arange(width), cut[f]]
            best = gain.argmax(axis=0)
            for k in np.flatnonzero(gain.max(axis=0) > 0):
                features[tree, first + k] = best[k]
                thresholds[tree, first + k] = edges[best[k]][cut[best[k], k]]
            node = 2 * node + 1 + (x[np.arange(n), features[tree, node]] > thresholds[tree, node])
        leaf = node - inner
        g, h = (np.bincount(leaf, w, minlength=leaves) for w in (gradient, hessian))
        values[tree] = rate * g / (h + l2)
        raw += values[tree][leaf]
    return Trees(features, thresholds, values, bias)
