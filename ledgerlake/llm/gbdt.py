"""Histogram gradient-boosted trees for a binary label, in numpy.

Features are cut into at most ``BINS`` quantile bins; each level of a tree sums gradients and
hessians per (node, feature, bin) with one ``bincount`` and takes the best split of each node.
A fitted model is flat arrays (feature, threshold, leaf value) of complete binary trees, so a
batch of rows is scored by stepping all rows down all levels at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes: go right if value > threshold
    value: np.ndarray      # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row of ``x``."""
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while inner and node[:1].size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.2,
        l2: float = 1.0, min_hessian: float = 1.0) -> Trees:
    """Fit on a bounded sample. Without rows, or with one class only, scores are the base rate."""
    n, k = x.shape
    mean = (y.sum() + 1) / (n + 2)
    base, inner = float(np.log(mean / (1 - mean))), 2 ** depth - 1
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) if n else
             np.zeros(0) for j in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1) \
        if k else np.zeros((n, 0), np.int64)
    margin, features, thresholds, values = np.full(n, base), [], [], []
    for _ in range(n_trees if 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            cell = (((node - first)[:, None] * k + np.arange(k)) * BINS + binned).ravel()
            g, h = (np.bincount(cell, np.repeat(w, k), width * k * BINS)
                    .reshape(width, k, BINS).cumsum(2) for w in (grad, hess))
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + l2) + (all_g - g) ** 2 / (all_h - h + l2) \
                - all_g ** 2 / (all_h + l2)
            gain[(h < min_hessian) | (all_h - h < min_hessian)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for i, cut in enumerate(best):
                j, b = divmod(int(cut), BINS)
                if gain[i, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + i], threshold[first + i] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + l2)
        margin += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    shape = (len(values), inner)
    return Trees(np.array(features, np.int64).reshape(shape), np.array(thresholds).reshape(shape),
                 np.array(values).reshape(len(values), inner + 1), base)
