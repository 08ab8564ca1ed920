"""Gradient-boosted trees on binned features, in numpy: logistic loss, depth-wise growth."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Complete trees of one depth: feature, threshold (x > t goes right) and leaf values."""

    depth: int
    base: float
    feature: np.ndarray = field(repr=False)
    threshold: np.ndarray = field(repr=False)
    leaf: np.ndarray = field(repr=False)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        trees = np.arange(len(self.feature))
        rows = np.arange(len(x))[:, None]
        at = np.zeros((len(x), len(trees)), np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        return self.base + self.leaf[trees, at - (2**self.depth - 1)].sum(1)


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, l2: float = 1.0, least: float = 2.0, weight: np.ndarray | None = None) -> Boosted:
    """Trees for labels ``y`` (0 or 1); the same data give the same trees."""
    n, m = x.shape
    weight = np.ones(n) if weight is None else weight
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)], 1)
    p = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    score = np.full(n, base)
    inner = 2**depth - 1
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-score))
        g, h = weight * (q - y), weight * q * (1 - q)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            key = (at - first) * (bins + 1)
            best = np.full(width, 1e-6)
            for j in range(m):
                k = key + binned[:, j]
                gs = np.bincount(k, g, width * (bins + 1)).reshape(width, -1).cumsum(1)
                hs = np.bincount(k, h, width * (bins + 1)).reshape(width, -1).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                gain[(hs < least) | (ht - hs < least)] = 0
                cut = gain[:, : len(edges[j])].argmax(1) if len(edges[j]) else np.zeros(width, np.int64)
                won = gain[np.arange(width), cut] > best if len(edges[j]) else np.zeros(width, bool)
                best[won] = gain[np.arange(width), cut][won]
                feature[first : first + width][won] = j
                threshold[first : first + width][won] = edges[j][cut[won]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf_of = at - inner
        leaf = -rate * np.bincount(leaf_of, g, 2**depth) / (np.bincount(leaf_of, h, 2**depth) + l2)
        score += leaf[leaf_of]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Boosted(depth, base, np.array(features), np.array(thresholds), np.array(leaves))
