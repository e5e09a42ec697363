"""Small decision trees in numpy, grown on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Node:
    value: float  # weighted share of label 1
    weight: float
    feature: int = -1
    threshold: float = 0.0
    low: Node | None = None  # feature <= threshold
    high: Node | None = None


def grow(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, features: int, rng: np.random.Generator,
    least: float = 8.0, cuts: int = 24,
) -> Node:
    """A tree by Gini impurity; each split looks at some features and at quantiles as thresholds."""
    total = float(w.sum())
    node = Node(float((w * y).sum() / total) if total else 0.0, total)
    if depth == 0 or total < 2 * least or node.value in (0.0, 1.0):
        return node
    best = 1e-7
    for feature in rng.permutation(x.shape[1])[:features]:
        values = x[:, feature]
        marks = np.unique(np.quantile(values, np.linspace(0, 1, cuts + 2)[1:-1]))
        below = values[:, None] <= marks
        w_low, y_low = w @ below, (w * y) @ below
        w_high, y_high = total - w_low, node.value * total - y_low
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = y_low**2 / w_low + y_high**2 / w_high - node.value**2 * total
        gain = np.where((w_low >= least) & (w_high >= least), gain / total, 0)
        at = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[at] > best:
            best, node.feature, node.threshold = float(gain[at]), int(feature), float(marks[at])
    if node.feature >= 0:
        below = x[:, node.feature] <= node.threshold
        node.low = grow(x[below], y[below], w[below], depth - 1, features, rng, least, cuts)
        node.high = grow(x[~below], y[~below], w[~below], depth - 1, features, rng, least, cuts)
    return node


def forest(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int, depth: int, features: int, seed: int, least: float = 8.0
) -> list[Node]:
    """Trees on samples drawn with repetition."""
    rng = np.random.default_rng(seed)
    grown = []
    for _ in range(trees):
        picked = rng.integers(len(y), size=len(y))
        grown.append(grow(x[picked], y[picked], w[picked], depth, features, rng, least))
    return grown


def tree_values(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    found = np.empty(len(x))
    below = x[:, node.feature] <= node.threshold
    found[below] = tree_values(node.low, x[below])
    found[~below] = tree_values(node.high, x[~below])
    return found


def forest_values(trees: list[Node], x: np.ndarray) -> np.ndarray:
    """Mean share of label 1 over the trees."""
    return np.mean([tree_values(tree, x) for tree in trees], axis=0) if len(x) else np.zeros(0)


Rule = tuple[tuple[int, bool, float], ...]


def paths(node: Node, so_far: Rule = ()) -> list[Rule]:
    """Every node but the root as the conditions that lead to it: (feature, is low side, threshold)."""
    if node.feature < 0:
        return []
    found = []
    for low, child in ((True, node.low), (False, node.high)):
        rule = (*so_far, (node.feature, low, node.threshold))
        found += [rule, *paths(child, rule)]
    return found
