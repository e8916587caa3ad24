"""Gradient-boosted trees in numpy, with monotonic constraints, for small labelled samples."""

from dataclasses import dataclass

import numpy as np

BINS = 64
TREES = 60
DEPTH = 4
STEP = 0.2
LEAST_WEIGHT = 4.0
PENALTY = 1.0


@dataclass(frozen=True)
class FlatTrees:
    """All trees in one set of node arrays; a leaf leads to itself."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        """Log-odds of every row; all rows go down all trees at once, a level at a time."""
        total = np.full(len(features), self.base)
        if not len(self.roots):
            return total
        for start in range(0, len(features), 4096):
            rows = features[start : start + 4096]
            node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
            at = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                goes_left = rows[at, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total[start : start + 4096] += self.value[node].sum(axis=1)
        return total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_trees(features: np.ndarray, labels: np.ndarray, signs: list[int], trees: int = TREES) -> FlatTrees:
    """Trees for 0/1 labels. ``signs`` has -1 or 1 where the score must fall or rise with a feature.

    With no rows, or rows of one class, the score is that class for every row.
    """
    nodes: dict[str, list] = {name: [] for name in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    positive = float(labels.mean()) if len(labels) else 1.0
    base = float(np.log((positive + 1e-4) / (1 - positive + 1e-4)))
    if not 0 < positive < 1:
        return flat(base, roots, nodes)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in features.T]
    binned = np.stack(
        [np.searchsorted(cuts, column) for cuts, column in zip(edges, features.T, strict=True)], axis=1
    )
    score = np.full(len(labels), base)
    for _ in range(trees):
        p = sigmoid(score)
        gradient, weight = labels - p, np.maximum(p * (1 - p), 1e-6)
        roots.append(grow(nodes, binned, edges, gradient, weight, signs, np.arange(len(labels)), DEPTH, -4.0, 4.0, score))
    return flat(base, roots, nodes)


def grow(nodes, binned, edges, gradient, weight, signs, rows, depth, low, high, score) -> int:
    """Add a node for ``rows`` whose values stay from ``low`` to ``high``; returns its place."""
    place = len(nodes["value"])
    for name, blank in (("feature", 0), ("threshold", 0.0), ("left", place), ("right", place), ("value", 0.0)):
        nodes[name].append(blank)
    split = best_split(binned, gradient, weight, signs, rows, low, high) if depth else None
    if split is None:
        value = STEP * np.clip(leaf(gradient[rows].sum(), weight[rows].sum()), low, high)
        nodes["value"][place] = float(value)
        score[rows] += value
        return place
    feature, cut, middle = split
    goes_left = binned[rows, feature] <= cut
    bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
    sides = bounds.get(signs[feature], ((low, high), (low, high)))
    nodes["feature"][place] = feature
    nodes["threshold"][place] = float(edges[feature][cut])
    for name, chosen, (least, most) in zip(("left", "right"), (goes_left, ~goes_left), sides, strict=True):
        nodes[name][place] = grow(
            nodes, binned, edges, gradient, weight, signs, rows[chosen], depth - 1, least, most, score
        )
    return place


def leaf(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient / (weight + PENALTY)


def best_split(binned, gradient, weight, signs, rows, low, high) -> tuple[int, int, float] | None:
    """Feature, bin and middle value of the split that gains most and keeps the order asked for."""
    g_all, w_all = gradient[rows].sum(), weight[rows].sum()
    best, found = 1e-6 + g_all**2 / (w_all + PENALTY), None
    for feature, sign in enumerate(signs):
        bins = binned[rows, feature]
        g = np.cumsum(np.bincount(bins, gradient[rows], BINS))[:-1]
        w = np.cumsum(np.bincount(bins, weight[rows], BINS))[:-1]
        below = np.clip(leaf(g, w), low, high)
        above = np.clip(leaf(g_all - g, w_all - w), low, high)
        allowed = (w >= LEAST_WEIGHT * 0.25) & (w_all - w >= LEAST_WEIGHT * 0.25)
        allowed &= (above - below) * sign >= 0
        gain = g**2 / (w + PENALTY) + (g_all - g) ** 2 / (w_all - w + PENALTY)
        gain = np.where(allowed, gain, -np.inf)
        cut = int(np.argmax(gain))
        if gain[cut] > best:
            best, found = gain[cut], (feature, cut, float((below[cut] + above[cut]) / 2))
    return found


def flat(base: float, roots: list[int], nodes: dict[str, list]) -> FlatTrees:
    kinds = {"feature": np.int32, "threshold": float, "left": np.int32, "right": np.int32, "value": float}
    arrays = {name: np.array(nodes[name], dtype=kind) for name, kind in kinds.items()}
    return FlatTrees(base, DEPTH, np.array(roots, dtype=np.int32), **arrays)
