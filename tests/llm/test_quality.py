from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracebook.llm import quality
from tracebook.llm.common import fold


def made(rng, n):
    for i in range(n):
        words = ["".join(rng.choices("abcdeins", k=rng.randrange(1, 9))) for _ in range(rng.randrange(10, 80))]
        kind = i % 6
        if kind == 0:
            words = [w + rng.choice(["###", "$$$"]) for w in words]
        elif kind == 1:
            words = [rng.choice(words)] * len(words)
        yield " ".join(words), int(kind > 1)


def test_statistics(docs):
    rows = quality.with_statistics(docs("Ab, c|\n\nAb, 1! Ab,", "", None, " \n")).collect()
    stat = {r.doc_id: r.stat.asDict() for r in rows}[0]
    assert stat["log_words"] == pytest.approx(np.log1p(5))
    assert stat["word_length"] == pytest.approx(13 / 5)
    assert stat["pipe_rate"] == stat["bang_rate"] == pytest.approx(1 / 5)
    assert stat["upper_share"] == pytest.approx(3 / 18) and stat["digit_share"] == pytest.approx(1 / 18)
    assert stat["distinct_words"] == pytest.approx(3 / 5) and stat["same_as_before"] == 0
    assert stat["line_words"] == pytest.approx(5 / 2)
    assert all(v == 0 for r in rows if r.doc_id in (1, 2) for v in r.stat.asDict().values())


def test_compiled_rules_score_as_the_model_does(docs):
    rng = random.Random(1)
    rows = list(made(rng, 300))
    found = sorted(quality.with_statistics(docs(*[t for t, _ in rows])).collect(), key=lambda r: r.doc_id)
    x, y = np.array([tuple(r.stat) for r in found]), np.array([v for _, v in rows], float)
    model = quality.fit_rules(x, y, np.ones(len(y)))
    assert 0 < len(model.rules) < 60
    scored = quality.with_statistics(docs(*[t for t, _ in rows])).withColumn("score", model.column()).collect()
    for r in scored:
        assert r.score == pytest.approx(model.scores(x[r.doc_id : r.doc_id + 1])[0])


def test_held_out_accuracy_nulls_repeats_and_clashing_names(docs, spark):
    rng = random.Random(2)
    rows = list(made(rng, 400))
    table = docs(*[(i, t) for i, (t, _) in enumerate(rows)], (500, None), (501, ""), (0, rows[0][0]), (None, "abc"))
    labels = spark.createDataFrame(
        [(i, y, 1) for i, (_, y) in enumerate(rows)] + [(None, 1, 1), (7, None, 1)], "doc_id long, quality int, score int"
    )
    table = table.withColumn("stat", F.lit(1)).withColumn("label", F.lit(2))
    found = quality.quality(table, labels, fold(F.col("doc_id"), 5) == 0).collect()
    assert len(found) == 404 and all(0 <= r.score <= 1 for r in found)
    right = [r.predicted == rows[r.doc_id][1] for r in found if r.held_out and r.doc_id and r.doc_id < 400]
    assert np.mean(right) > 0.95


def test_one_class_only_and_empty_tables(docs, spark):
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    assert {r.predicted for r in quality.quality(docs("a", "b"), labels, F.lit(False)).collect()} == {1}
    assert quality.quality(docs("a").limit(0), labels.limit(0), F.lit(False)).collect() == []
