"""Gradient-boosted trees for two classes on a bounded sample, with histograms of few bins."""

from dataclasses import dataclass

import numpy as np

BINS = 24


@dataclass(frozen=True)
class Trees:
    """Complete trees: inner nodes as (feature, border), a row is on the right if its value is above."""

    base: float
    features: np.ndarray
    borders: np.ndarray
    leaves: np.ndarray

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        depth = int(np.log2(self.leaves.shape[1])) if self.leaves.size else 0
        for features, borders, leaves in zip(self.features, self.borders, self.leaves):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[at, features[node]] > borders[node])
            total += leaves[node - len(features)]
        return 1 / (1 + np.exp(-total))


def fit(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, smoothing: float = 2.0) -> Trees:
    """Logistic loss with Newton steps. Every tree has all ``2 ** depth`` leaves; a node that gains nothing
    by a split sends all rows to the left."""
    n, width = rows.shape
    inner = 2**depth - 1
    mean = np.clip(np.average(labels, weights=weights) if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    if not n or labels.min() == labels.max():
        return Trees(base, np.empty((0, inner), np.int64), np.empty((0, inner)), np.empty((0, inner + 1)))
    borders = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.column_stack([np.searchsorted(b, rows[:, f], "left") for f, b in enumerate(borders)])
    offsets = np.arange(width) * BINS
    total = np.full(n, base)
    out_features, out_borders, out_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, curvature = weights * (labels - p), weights * np.maximum(p * (1 - p), 1e-6)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            count, first = 2**level, 2**level - 1
            cell = ((node - first)[:, None] * (width * BINS) + offsets + binned).ravel()
            sums = [np.bincount(cell, np.repeat(x, width), count * width * BINS).reshape(count, width, BINS) for x in (gradient, curvature)]
            left_g, left_h = (s.cumsum(axis=2) for s in sums)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]

            def gain(g, h):
                return g * g / (h + smoothing)

            better = gain(left_g, left_h) + gain(all_g - left_g, all_h - left_h) - gain(all_g, all_h)
            better[:, :, -1] = 0
            best = better.reshape(count, -1).argmax(axis=1)
            for k, choice in enumerate(best.tolist()):
                f, b = divmod(choice, BINS)
                if b < len(borders[f]) and better[k, f, b] > 1e-6:
                    features[first + k], cuts[first + k] = f, borders[f][b]
            node = 2 * node + 1 + (rows[np.arange(n), features[node]] > cuts[node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, curvature, inner + 1)
        leaves = rate * g / (h + smoothing)
        total += leaves[leaf]
        out_features.append(features)
        out_borders.append(cuts)
        out_leaves.append(leaves)
    return Trees(base, np.array(out_features), np.array(out_borders), np.array(out_leaves))
