"""Gradient-boosted trees for two classes, in numpy: small training sets, histogram splits."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Level by level: inner node i has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def leaf_values(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while at[0] < len(self.feature) if len(at) else False:
            right = x[np.arange(len(x)), self.feature[at]] > self.cut[at]
            at = 2 * at + 1 + right
        return self.value[at - len(self.feature)]


@dataclass
class Boosted:
    offset: float
    trees: list[Tree] = field(default_factory=list)
    # Platt calibration on rows set aside.
    scale: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.offset + sum((t.leaf_values(x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margin(x) + self.shift, -60, 60)))


def _grow(x: np.ndarray, binned: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, depth: int, ridge: float, rate: float) -> Tree:
    inner = 2**depth - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    at = np.zeros(len(x), np.int64)
    n_bins = max(len(e) for e in edges) + 1
    for node in range(inner):
        rows = np.flatnonzero(at == node)
        best = 1e-9
        g, h = slope[rows].sum(), curve[rows].sum()
        for f, edge in enumerate(edges):
            if not len(edge) or not len(rows):
                continue
            gl = np.cumsum(np.bincount(binned[rows, f], slope[rows], n_bins))[: len(edge)]
            hl = np.cumsum(np.bincount(binned[rows, f], curve[rows], n_bins))[: len(edge)]
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            b = int(np.argmax(gain))
            if gain[b] > best:
                best, feature[node], cut[node] = gain[b], f, edge[b]
        at[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    leaf = at - inner
    total, weight = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
    return Tree(feature, cut, -rate * total / (weight + ridge))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, bins: int = 32) -> Boosted:
    """Newton boosting on the logistic loss. Splits are tried at quantiles of each feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(prior / (1 - prior))))
    margin = np.full(len(y), model.offset)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, binned, edges, p - y, np.maximum(p * (1 - p), 1e-6), depth, ridge, rate)
        model.trees.append(tree)
        margin += tree.leaf_values(x)
    return model


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray, steps: int = 50) -> None:
    """Platt scaling with smoothed targets, on rows the trees have not seen."""
    m = model.margin(x)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    beta = np.array([1.0, 0.0])
    design = np.stack([m, np.ones_like(m)], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -60, 60)))
        curve = (design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta - np.linalg.solve(curve, design.T @ (p - target) + 1e-3 * (beta - [1.0, 0.0]))
    model.scale, model.shift = float(beta[0]), float(beta[1])


def threshold_for(probability: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest threshold with that precision on the given rows; above 1 if there is none."""
    order = np.argsort(-probability, kind="stable")
    hits = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last_of_value = np.append(probability[order][1:] != probability[order][:-1], True)
    good = np.flatnonzero((hits >= precision) & last_of_value)
    return float(probability[order][good[-1]]) if len(good) else 1.1
