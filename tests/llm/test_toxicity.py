from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracebook.llm import toxicity
from tracebook.llm.common import fold

BAD = ["idiot", "scum", "vequta", "vequmo", "vequais"]


def made(rng, n):
    words = ["".join(rng.choices("abcdenorst", k=rng.randrange(2, 8))) for _ in range(400)]
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(5, 150))
        toxic = i % 4 == 0
        for _ in range(2 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(BAD) + rng.choice(["", ",", "!"]))
        yield " ".join(text), int(toxic)


@pytest.fixture(scope="module")
def network():
    return toxicity.train(list(made(random.Random(1), 400)), steps=150)


def test_held_out_accuracy(network):
    rows = list(made(random.Random(1), 700))[400:]
    score = toxicity.sigmoid(toxicity.logits(network, [t.encode() for t, _ in rows]))
    assert np.mean((score >= 0.7) == np.array([y for _, y in rows])) > 0.97


def test_unseen_words_are_known_by_their_characters(network):
    texts = ["abc den " * 20 + w for w in ("vequzzt", "norster")]
    bad, good = toxicity.logits(network, [t.encode() for t in texts])
    assert bad > good + 1


def test_every_window_of_a_long_text_counts(network):
    clean = "nor sta " * 40_000
    at = len(clean) // 2 // 8 * 8
    bad, good = toxicity.logits(network, [(clean[:at] + "idiot scum " + clean[at:]).encode(), clean.encode()])
    assert bad > good + 1


def test_windows_cover_every_word():
    for sizes in ([0, 1, 31, 32, 33, 48, 49, 200], [0], [5]):
        sizes = np.array(sizes)
        owner, ids = toxicity.windows(np.arange(sizes.sum()), sizes)
        assert set(ids[ids >= 0].tolist()) == set(range(sizes.sum()))
        assert (np.bincount(owner, minlength=len(sizes)) > 0).tolist() == (sizes > 0).tolist()


def test_gradients_are_the_slopes_of_the_loss():
    words = [b"abc", b"idiot", b"nor"]
    network = toxicity.Network({b"abc": 1, b"idiot": 2})
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    ids = np.array([[0, 1, 2, -1], [2, 0, -1, -1]])
    x, trace = network.inputs(words)
    slope = np.array([1.0, -0.5])
    _, memory = network.run(x, ids, keep=True)
    g, by_x = network.gradients(memory, slope)
    g |= network.input_gradients(trace, by_x)
    for name, at in [("in_fw", (1, 2)), ("in_bw", (0, 7)), ("gate_fw", (1, 3)), ("new_bw", (2, 2)), ("b_fw", (8,)),
                     ("attend", (3,)), ("out", (9,)), ("bias", (0,)), ("words", (2, 1))]:
        values = []
        for change in (1e-2, -2e-2):
            network.p[name][at] += change
            values.append(float(slope @ network.run(network.inputs(words)[0], ids)[0]))
        network.p[name][at] += 1e-2
        assert g[name][at] == pytest.approx((values[0] - values[1]) / 2e-2, rel=0.05, abs=1e-4), name


def test_query_columns_nulls_repeats_and_clashing_names(docs, spark):
    rng = random.Random(3)
    rows = list(made(rng, 120))
    table = docs(*[(i, t) for i, (t, _) in enumerate(rows)], (500, None), (501, ""), (0, rows[0][0]), (None, "abc"))
    labels = spark.createDataFrame(
        [(i, y, 1) for i, (_, y) in enumerate(rows)] + [(None, 1, 1), (7, None, 1)], "doc_id long, toxic int, score int"
    )
    table = table.withColumn("score", F.lit("x")).withColumn("row", F.lit("y")).withColumn("label", F.lit(1))
    found = toxicity.toxicity(table, labels, fold(F.col("doc_id"), 3) == 1).collect()
    assert len(found) == 124 and found[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    assert all(r.score < 0.01 for r in found if r.doc_id in (500, 501))
    kept = toxicity.scored(table, toxicity.train(rows, steps=5), "toxic")
    assert kept.columns == [*table.columns, "toxic"] and kept.count() == 124


def test_one_class_only_and_empty_tables(docs, spark):
    table = docs("a", "b")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.toxicity(table, none, F.lit(False)).collect()
    assert {r.predicted for r in found} == {0}
    assert toxicity.toxicity(table.limit(0), none, F.lit(False)).collect() == []


def labelled(docs, spark, rows):
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    return docs(*[(i, t) for i, (t, _) in enumerate(rows)]), labels


def test_network_is_trained_on_all_labelled_documents(docs, spark):
    rows = list(made(random.Random(4), 60))
    rows += [(f"nor sta {'abc den ' * 4000} zymurgy text{i}", i % 2) for i in range(4)]  # over 20,000 characters
    table, labels = labelled(docs, spark, rows)
    network = toxicity.fitted(table, labels, F.col("doc_id") != 63)
    assert b"zymurgy" in network.vocabulary


def test_counts_are_those_of_all_rows(docs, spark):
    rows = list(made(random.Random(6), 200)) + [("", 1), ("!", 0), ("abc", 1)]
    table, labels = labelled(docs, spark, rows)
    found = toxicity.labelled(table.union(table.limit(9)).repartition(5), labels, "toxic", F.col("doc_id") % 7 != 1)
    used = [(set(toxicity.bare_words(t.encode())), y) for i, (t, y) in enumerate(rows) if i % 7 != 1]
    assert found.count() == len(used)
    network, evidence = toxicity.counted(found)
    every = {w for held, _ in used for w in held}
    want = {w: [sum(w in held for held, y in used if y == side) for side in (0, 1)] for w in every}
    assert set(network.vocabulary) == {w for w, n in want.items() if sum(n) >= toxicity.MIN_DOCS}
    assert all(evidence.words[:, at].tolist() == want[w] for w, at in network.vocabulary.items())
    assert evidence.documents.tolist() == [sum(bool(held) for held, y in used if y == side) for side in (0, 1)]
    fewer, _ = toxicity.counted(found, 20)
    least = min(sum(want[w]) for w in fewer.vocabulary)
    assert 0 < len(fewer.vocabulary) <= 20 and set(fewer.vocabulary) == {w for w, n in want.items() if sum(n) >= least}


def test_every_row_is_in_a_shard_and_the_same_rows_give_the_same_network(docs, spark, monkeypatch):
    monkeypatch.setattr(toxicity, "RARER", 40)
    rows = list(made(random.Random(7), 700))
    table, labels = labelled(docs, spark, rows)
    found = toxicity.labelled(table, labels, "toxic", F.lit(True))
    split = toxicity.shards(found, np.array([525, 175]), steps=8).select("shard", "key", "label").collect()
    assert {r.key for r in split} == {r.key for r in found.collect()}
    assert {(r.shard, r.label) for r in split} == {(s, y) for s in range(5) for y in (0, 1)}
    assert sum(r.label == 0 for r in split) == 525
    first, second = (toxicity.fitted(t, labels, F.lit(True), steps=8) for t in (table, table.repartition(5)))
    assert all((first.p[name] == second.p[name]).all() for name in first.p)


def test_mean_of_shards_learns(docs, spark):
    table, labels = labelled(docs, spark, list(made(random.Random(1), 2400)))
    network = toxicity.fitted(table, labels, F.lit(True), steps=80)  # two shards
    rows = list(made(random.Random(1), 2900))[2400:]
    score = toxicity.sigmoid(toxicity.logits(network, [t.encode() for t, _ in rows]))
    assert np.mean((score >= 0.7) == np.array([y for _, y in rows])) > 0.95
