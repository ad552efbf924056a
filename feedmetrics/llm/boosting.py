"""Gradient-boosted trees and isotonic calibration in numpy, for small dense tables."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Boosted:
    """Trees of equal depth as arrays: a node's children are ``2 i + 1`` and ``2 i + 2``."""

    prior: float
    depth: int
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> Boosted:
    """Second-order boosting of the logistic loss on histograms of at most ``BINS`` bins.

    One class alone, or no rows, gives the constant of the class's share (one half without rows).
    """
    share = np.clip((y.sum() + 0.5) / (len(y) + 1), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), depth)
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    margin = np.full(len(y), model.prior)
    n_features = x.shape[1]
    for _ in range(trees):
        p = _sigmoid(margin)
        slope, curve = y - p, p * (1 - p)
        feature = np.zeros(2**depth - 1, np.int64)
        cut = np.full(2**depth - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-9)
            for f in range(n_features):
                if not len(edges[f]):
                    continue
                cell = local * (BINS + 1) + binned[:, f]
                g = np.bincount(cell, slope, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                h = np.bincount(cell, curve, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = (g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge))[:, : len(edges[f])]
                at = gain.argmax(1)
                better = gain[np.arange(width), at] > best
                best = np.where(better, gain[np.arange(width), at], best)
                feature[first: first + width][better] = f
                cut[first: first + width][better] = edges[f][at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - (2**depth - 1)
        g, h = np.bincount(leaf, slope, 2**depth), np.bincount(leaf, curve, 2**depth)
        values = rate * g / (h + ridge)
        margin += values[leaf]
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(values)
    return model


def isotonic(scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: points of a rising curve from score to probability.

    Each end is softened by half a case, so that no score is called certain. Without cases the curve
    is the logistic function.
    """
    if len(y) == 0 or y.min() == y.max():
        grid = np.linspace(-8, 8, 65)
        return grid, _sigmoid(grid)
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []       # sum of y, cases, lowest and highest score
    for s, v in zip(scores[order], y[order].astype(float)):
        blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            v1, n1, _, high = blocks.pop()
            blocks[-1][0] += v1
            blocks[-1][1] += n1
            blocks[-1][3] = high
    total = len(y)
    xs, ps = [], []
    for v, n, low, high in blocks:
        p = np.clip(v / n, 0.5 / total, 1 - 0.5 / total)
        xs += [low, high] if high > low else [low]
        ps += [p, p] if high > low else [p]
    return np.array(xs), np.array(ps)


def calibrated(margin: np.ndarray, curve: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Probabilities on the curve; a trace of the margin keeps the order of equal ones."""
    p = np.interp(margin, *curve)
    return np.clip(p + 1e-6 * (_sigmoid(margin) - 0.5), 0, 1)
