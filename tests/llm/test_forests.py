from __future__ import annotations

import numpy as np
import pytest

from tracebook.llm import forests
from tracebook.llm.trees import forest_values

ROW = "key long, part int, label int, weight long, x array<double>"


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 4)).round(3)
    label = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.25)).astype(int)
    keys = rng.integers(-(2**62), 2**62, 3000)
    return [(int(k), int(y), int(y), forests.UNIT // 4, v.tolist()) for k, y, v in zip(keys, label, x, strict=True)]


def test_root_split_is_the_best_of_all_rows(spark, points):
    rows = spark.createDataFrame(points, ROW)
    (tree,) = forests.grown(rows, 4, trees=1, depth=1, features=4, seed=7, least=2.0)
    x, y = np.array([p[4] for p in points]), np.array([p[1] for p in points])
    w = forests.times_drawn(np.array([p[0] for p in points]), 1, 7)[:, 0] / 4
    gains = {}
    for f, limits in enumerate(forests.cuts(rows, 4)):
        for c in limits:
            low, high = w * (x[:, f] <= c), w * (x[:, f] > c)
            if min(low.sum(), high.sum()) >= 2:
                gains[f, c] = (low @ y) ** 2 / low.sum() + (high @ y) ** 2 / high.sum()
    assert gains[tree.feature, tree.threshold] == pytest.approx(max(gains.values()))
    assert tree.value == pytest.approx(w @ y / w.sum())
    below = w * (x[:, tree.feature] <= tree.threshold)
    assert tree.low.value == pytest.approx(below @ y / below.sum())


def test_forest_fits_and_does_not_depend_on_partitions(spark, points):
    rows = spark.createDataFrame(points, ROW)
    trees = forests.grown(rows.repartition(1), 4, trees=10, depth=6, features=3, seed=1, least=2.0)
    assert trees == forests.grown(rows.repartition(9), 4, trees=10, depth=6, features=3, seed=1, least=2.0)
    values = forest_values(trees, np.array([p[4] for p in points]))
    assert ((values > 0.5) == np.array([p[1] for p in points])).mean() > 0.95


def test_draws_are_poisson():
    times = forests.times_drawn(np.arange(50_000), 3, 5)
    assert np.abs(times.mean(axis=0) - 1).max() < 0.03 and np.abs(times.var(axis=0) - 1).max() < 0.05
    assert abs(np.corrcoef(times.T)[0, 1]) < 0.02
