"""Gradient-boosted trees on small, bounded training sets, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """Complete binary tree: inner nodes test feature <= cut, leaves add a value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        for _ in range(int(np.log2(len(self.value)))):
            node = 2 * node + 1 + (rows[np.arange(len(rows)), self.feature[node]] > self.cut[node])
        return self.value[node - len(self.feature)]


@dataclass
class Boosted:
    """Logistic model: a start value and trees whose leaves add to the log odds."""

    start: float
    trees: list[Tree]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        odds = np.full(len(rows), self.start)
        for tree in self.trees:
            odds += tree.leaves(rows)
        return 1 / (1 + np.exp(-odds))


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3,
        bins: int = 16, penalty: float = 1.0) -> Boosted:
    """Second-order boosting on quantile histograms."""
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), [])
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(rows.shape[1])], axis=1)
    odds = np.full(len(rows), model.start)
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-odds))
        slope, bend = labels - chance, chance * (1 - chance)
        inner = (1 << depth) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.full(count, 1e-9)
            for f, edges in enumerate(cuts):
                if not len(edges):
                    continue
                width = len(edges) + 1
                place = (node - first) * width + binned[:, f]
                g = np.bincount(place, slope, count * width).reshape(count, width).cumsum(axis=1)
                h = np.bincount(place, bend, count * width).reshape(count, width).cumsum(axis=1)
                left, right = (g[:, :-1], h[:, :-1]), (g[:, -1:] - g[:, :-1], h[:, -1:] - h[:, :-1])
                gain = sum(a * a / (b + penalty) for a, b in (left, right)) - g[:, -1:] ** 2 / (h[:, -1:] + penalty)
                top = gain.argmax(axis=1)
                better = gain[np.arange(count), top] > best
                best = np.where(better, gain[np.arange(count), top], best)
                feature[first : first + count] = np.where(better, f, feature[first : first + count])
                cut[first : first + count] = np.where(better, edges[top], cut[first : first + count])
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > cut[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, slope, 1 << depth) / (np.bincount(leaf, bend, 1 << depth) + penalty)
        model.trees.append(Tree(feature, cut, value))
        odds += value[leaf]
    return model


def threshold_for(scores: np.ndarray, labels: np.ndarray, precision: float, least: float = 0.5) -> float:
    """Smallest score at which what lies above is right with the given precision, at least ``least``."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    last_of_tie = np.concatenate((scores[order][1:] != scores[order][:-1], [True]))
    good = np.nonzero((right >= precision) & last_of_tie)[0]
    return max(float(scores[order][good[-1]]), least) if len(good) else 1.1
