"""Gradient boosted trees on numpy arrays: logistic loss, histogram splits.

Rows may carry weights, so that one may stand for many of the same bins. One label alone, or features that are all constant, give trees that predict the
weighted share of the label; there must be at least one row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: split feature and cut per inner node, value per leaf."""

    start: float
    features: np.ndarray  # trees x inner nodes; -1 sends every row left
    cuts: np.ndarray
    leaves: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        inner = self.features.shape[1]
        rows = np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), int)
            while len(node) and node[0] < inner:
                feature = features[node]
                right = (feature >= 0) & (x[rows, np.maximum(feature, 0)] > cuts[node])
                node = 2 * node + 1 + right
            out += leaves[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, *, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0,
    edges: list[np.ndarray] | None = None,
) -> Trees:
    """``edges`` are the upper ends of all bins but the last per feature; else quantiles of the rows."""
    edges = edges or [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    weights = np.ones(len(y)) if weights is None else weights
    share = np.clip(np.average(y, weights=weights), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    raw = np.full(len(y), start)
    inner = 2**depth - 1
    all_features, all_cuts, all_leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        slope, curve = weights * (y - p), weights * p * (1 - p)
        features, cuts = np.full(inner, -1), np.zeros(inner)
        node = np.zeros(len(y), int)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            best = np.full(count, 1e-9)
            total_g = np.bincount(at, slope, count)
            total_h = np.bincount(at, curve, count)
            base = total_g**2 / (total_h + ridge)
            split_bin = np.zeros(count, int)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                width = len(e) + 1
                cell = at * width + binned[:, j]
                g = np.bincount(cell, slope, count * width).reshape(count, width).cumsum(1)[:, :-1]
                h = np.bincount(cell, curve, count * width).reshape(count, width).cumsum(1)[:, :-1]
                rest_g, rest_h = total_g[:, None] - g, total_h[:, None] - h
                gain = g**2 / (h + ridge) + rest_g**2 / (rest_h + ridge) - base[:, None]
                where = gain.argmax(1)
                value = gain[np.arange(count), where]
                better = value > best
                best = np.where(better, value, best)
                features[first : first + count][better] = j
                split_bin = np.where(better, where, split_bin)
            for k in range(count):
                if features[first + k] >= 0:
                    cuts[first + k] = edges[features[first + k]][split_bin[k]]
            feature = features[node]
            right = (feature >= 0) & (x[np.arange(len(x)), np.maximum(feature, 0)] > cuts[node])
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
        leaves = rate * g / (h + ridge)
        raw += leaves[leaf]
        all_features.append(features)
        all_cuts.append(cuts)
        all_leaves.append(leaves)
    return Trees(start, np.array(all_features), np.array(all_cuts), np.array(all_leaves))
