"""A random forest for two classes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    feature: np.ndarray  # -1 at leaves
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray  # of the positive class among the rows that reached the node

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return self.share[at]
            rows, nodes = np.flatnonzero(inner), at[inner]
            low = x[rows, self.feature[nodes]] <= self.threshold[nodes]
            at[rows] = np.where(low, self.left[nodes], self.right[nodes])


def _best_split(x: np.ndarray, y: np.ndarray, features: np.ndarray) -> tuple[float, int, float]:
    """Lowest weighted Gini impurity over all cuts between different values; (impurity, feature, threshold)."""
    best = (np.inf, -1, 0.0)
    n, total = len(y), y.sum()
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        values, hits = x[order, f], np.cumsum(y[order])[:-1]
        cut = np.flatnonzero(values[1:] > values[:-1])
        if not len(cut):
            continue
        left, p = cut + 1.0, hits[cut]
        right, q = n - left, total - p
        impurity = p * (left - p) / left + q * (right - q) / right
        at = int(np.argmin(impurity))
        if impurity[at] < best[0] - 1e-12:
            best = (float(impurity[at]), int(f), float((values[cut[at]] + values[cut[at] + 1]) / 2))
    return best


def _grow(x: np.ndarray, y: np.ndarray, depth: int, least: int, tried: int, rng: np.random.Generator) -> Tree:
    nodes: list[list] = []

    def add(rows: np.ndarray, level: int) -> int:
        number = len(nodes)
        nodes.append([-1, 0.0, -1, -1, (y[rows].sum() + 0.5) / (len(rows) + 1)])
        if level < depth and len(rows) >= 2 * least and 0 < y[rows].sum() < len(rows):
            _, feature, threshold = _best_split(x[rows], y[rows], rng.choice(x.shape[1], tried, replace=False))
            if feature >= 0:
                low = x[rows, feature] <= threshold
                nodes[number][:4] = [feature, threshold, add(rows[low], level + 1), add(rows[~low], level + 1)]
        return number

    add(np.arange(len(y)), 0)
    columns = list(zip(*nodes, strict=True))
    return Tree(np.array(columns[0]), np.array(columns[1]), np.array(columns[2]), np.array(columns[3]), np.array(columns[4]))


class Forest:
    """Trees on bootstrap samples, each split on a random few features. Without both classes it always says their share."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 32, depth: int = 10, least: int = 2, seed: int = 3) -> None:
        rng, y = np.random.default_rng(seed), y.astype(float)
        self.constant = float(y.mean()) if len(y) else 0.0
        self.trees: list[Tree] = []
        if len(y) and 0 < y.sum() < len(y):
            tried = max(1, int(np.sqrt(x.shape[1])))
            for _ in range(trees):
                rows = rng.integers(0, len(y), len(y))
                self.trees.append(_grow(x[rows], y[rows], depth, least, tried, rng))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or not len(x):
            return np.full(len(x), self.constant)
        return np.mean([t.predict(x) for t in self.trees], axis=0)
