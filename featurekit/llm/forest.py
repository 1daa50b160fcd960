"""A small random forest in NumPy: Gini splits at quantile thresholds, grown on bootstrap samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Per tree: split feature (-1 in a leaf), threshold, left child (right is the next), share of positives."""

    trees: tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], ...]

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, threshold, child, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                inner = np.flatnonzero(feature[node] >= 0)
                if not len(inner):
                    break
                at = node[inner]
                node[inner] = child[at] + (x[inner, feature[at]] > threshold[at])
            total += value[node]
        return total / max(1, len(self.trees))


def grow_one(x: np.ndarray, y: np.ndarray, number: int, depth: int = 9, leaf: int = 3, cuts: int = 24, seed: int = 5) -> tuple[np.ndarray, ...]:
    """Tree ``number`` of a forest whose trees have rows of their own."""
    rng = np.random.default_rng([seed, number])
    return _tree(x, y, rng.integers(0, len(x), len(x)), depth, leaf, cuts, rng)


def grow(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 9, leaf: int = 3, cuts: int = 24, seed: int = 5) -> Forest:
    rng = np.random.default_rng(seed)
    return Forest(tuple(_tree(x, y, rng.integers(0, len(x), len(x)), depth, leaf, cuts, rng) for _ in range(trees)))


def _tree(x, y, rows, depth, leaf, cuts, rng):
    feature, threshold, child, value = [-1], [0.0], [0], [float(y[rows].mean())]
    stack = [(0, rows, depth)]
    tried = max(1, int(np.sqrt(x.shape[1])) + 1)
    while stack:
        node, rows, left = stack.pop()
        labels = y[rows]
        if left == 0 or len(rows) < 2 * leaf or labels.min() == labels.max():
            continue
        best = None
        for f in rng.choice(x.shape[1], tried, replace=False):
            values = x[rows, f]
            for cut in np.unique(np.quantile(values, np.linspace(0.02, 0.98, cuts))):
                low = values <= cut
                n = int(low.sum())
                if n < leaf or len(rows) - n < leaf:
                    continue
                a, b = labels[low].mean(), labels[~low].mean()
                impurity = n * a * (1 - a) + (len(rows) - n) * b * (1 - b)
                if best is None or impurity < best[0]:
                    best = (impurity, f, cut, low)
        if best is None:
            continue
        _, f, cut, low = best
        feature[node], threshold[node], child[node] = int(f), float(cut), len(feature)
        for part in (rows[low], rows[~low]):
            stack.append((len(feature), part, left - 1))
            feature.append(-1)
            threshold.append(0.0)
            child.append(0)
            value.append(float(y[part].mean()))
    return np.array(feature), np.array(threshold), np.array(child), np.array(value)
