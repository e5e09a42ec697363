"""Random forests grown on tables of any size, level by level.

Every level is one pass over the rows: tasks sum the weights per node, tried feature and bin, Spark
adds the sums up, and each node takes its best split from them. What reaches the driver is bounded
by trees, depth, tried features and bins, whatever the number of rows.

How often a tree draws a row is a Poisson number from a hash of the row's key and the tree, and
weights are whole numbers, so the same rows give the same forest however they are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracebook.llm.trees import Node

UNIT = 1 << 40  # of weights; their sum has to stay under 2**53
GRID = 256
SLOTS_AT_ONCE = 512
DRAWS = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(12)])


def cuts(rows: DataFrame, width: int, marks: int = 24) -> list[np.ndarray]:
    """Thresholds per feature: quantiles of the rows of every ``part``.

    They are exact for values on a grid of 1/256, on which few are distinct in any number of rows.
    """
    shares = [float(s) for s in np.linspace(0, 1, marks + 2)[1:-1]]
    values = (F.round(F.col("x")[i] * GRID) / GRID for i in range(width))
    found = rows.groupBy("part").agg(*[F.percentile(v, shares).alias(f"x{i}") for i, v in enumerate(values)]).collect()
    return [np.unique([v for r in found for v in r[f"x{i}"]]) for i in range(width)]


def times_drawn(keys: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """Rows by trees: Poisson numbers of mean 1."""
    streams = np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    mixed = keys.view(np.uint64)[:, None] ^ streams
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(factor)
    return np.searchsorted(DRAWS, ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)) / 2.0**53)


def _sums(limits: list[np.ndarray], bins: int, feature: np.ndarray, cut: np.ndarray, slot: np.ndarray,
          tried: np.ndarray, level: int, seed: int):
    trees, many = len(slot), tried.shape[1]

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_trees = np.arange(trees)
        weights, ones = np.zeros(tried.size * bins), np.zeros(tried.size * bins)
        for batch in batches:
            n = batch.num_rows
            x = np.asarray(batch.column("x").flatten()).reshape(n, len(limits))
            binned = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(limits)], axis=1)
            node, rows = np.ones((n, trees), np.int64), np.arange(n)[:, None]
            for _ in range(level):
                split = feature[all_trees, node]
                high = binned[rows, np.maximum(split, 0)] > cut[all_trees, node]
                node = np.where(split >= 0, 2 * node + high, node)
            place = slot[all_trees, node]
            times = times_drawn(np.asarray(batch.column("key")), trees, seed)
            row, tree = np.nonzero((place >= 0) & (times > 0))
            at = place[row, tree]
            weight = (times[row, tree] * np.asarray(batch.column("weight"))[row]).astype(float)
            one = weight * np.asarray(batch.column("label"))[row]
            cell = ((at[:, None] * many + np.arange(many)) * bins + binned[row[:, None], tried[at]]).ravel()
            # sums of whole numbers under 2**53 are exact
            weights += np.bincount(cell, np.repeat(weight, many), len(weights))
            ones += np.bincount(cell, np.repeat(one, many), len(ones))
        cells = np.flatnonzero(weights)
        columns = [pa.array(c.astype(np.int64)) for c in (cells, weights[cells], ones[cells])]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "weight", "ones"])

    return emit


def _splits(sums: pa.Table, tried: np.ndarray, bins: int, least: float) -> Iterator[tuple]:
    """Per slot: its weight and that of label 1, and its best split (feature, bin, weights below) or None."""
    cells, w, y = (np.asarray(sums.column(c)) for c in ("cell", "weight", "ones"))
    many = tried.shape[1]
    for first in range(0, len(tried), SLOTS_AT_ONCE):
        n = min(SLOTS_AT_ONCE, len(tried) - first)
        here = (cells >= first * many * bins) & (cells < (first + n) * many * bins)
        at = cells[here] - first * many * bins
        below = np.zeros((2, n * many * bins))
        below[0, at], below[1, at] = w[here] / UNIT, y[here] / UNIT
        w_low, y_low = below.reshape(2, n, many, bins).cumsum(axis=3)
        total, ones = w_low[:, :, -1:], y_low[:, :, -1:]
        w_high, y_high = total - w_low, ones - y_low
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (y_low**2 / w_low + y_high**2 / w_high - ones**2 / total) / total
        gain = np.where((w_low >= least) & (w_high >= least), gain, 0).reshape(n, -1)
        for i, best in enumerate(gain.argmax(axis=1)):
            j, b = divmod(int(best), bins)
            found = (int(tried[first + i, j]), b, w_low[i, j, b], y_low[i, j, b]) if gain[i, best] > 1e-7 else None
            yield total[i, 0, 0], ones[i, 0, 0], found


def grown(rows: DataFrame, width: int, trees: int, depth: int, features: int, seed: int, least: float) -> list[Node]:
    """A forest on ``rows``: key long, part int, label int, weight long (in ``UNIT``), x array of ``width`` doubles.

    It is read once per level. Splits by Gini impurity, each over some features; ``least`` is the
    weight that a side has at least. ``part`` groups the rows that thresholds are taken from.
    """
    limits = cuts(rows, width)
    bins = max(map(len, limits)) + 1
    shape = (trees, 2 << depth)
    feature, cut = np.full(shape, -1), np.zeros(shape, np.int64)
    weight, ones = np.zeros(shape), np.zeros(shape)
    open_nodes = [(tree, 1) for tree in range(trees)]
    for level in range(depth):
        if not open_nodes:
            break
        slot = np.full(shape, -1)
        for at, place in enumerate(open_nodes):
            slot[place] = at
        tried = np.array([np.random.default_rng((seed, *place)).permutation(width)[:features] for place in open_nodes])
        emit = _sums(limits, bins, feature, cut, slot, tried, level, seed)
        cells = rows.select("key", "label", "weight", "x").mapInArrow(emit, "cell long, weight long, ones long")
        sums = cells.groupBy("cell").agg(F.sum("weight").alias("weight"), F.sum("ones").alias("ones")).toArrow()
        places, open_nodes = open_nodes, []
        for (tree, node), (total, part, split) in zip(places, _splits(sums, tried, bins, least), strict=True):
            weight[tree, node], ones[tree, node] = total, part
            if split is None:
                continue
            feature[tree, node], cut[tree, node], w_low, y_low = split
            for child, w, y in ((2 * node, w_low, y_low), (2 * node + 1, total - w_low, part - y_low)):
                weight[tree, child], ones[tree, child] = w, y
                if w >= 2 * least and 0 < y < w:
                    open_nodes.append((tree, child))

    def tree_of(tree: int, node: int) -> Node:
        total = float(weight[tree, node])
        found = Node(float(ones[tree, node]) / total if total else 0.0, total)
        if feature[tree, node] >= 0:
            found.feature = int(feature[tree, node])
            found.threshold = float(limits[found.feature][cut[tree, node]])
            found.low, found.high = tree_of(tree, 2 * node), tree_of(tree, 2 * node + 1)
        return found

    return [tree_of(tree, 1) for tree in range(trees)]
