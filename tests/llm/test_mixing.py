from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tracebook.llm import mixing

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, s, t in rows], DOC)


def targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what exceeds a cap is shared out again until nothing does."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[at % len(weights)] for at, name in enumerate(names)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[name] for name in full)
        open_ = sum(weight[name] for name in names if name not in full)
        found = {n: most * sizes[n] if n in full else rest * weight[n] / open_ for n in names}
        more = {n for n in names if n not in full and found[n] > most * sizes[n]}
        if not more:
            return found
        full |= more


def lots(rng, source, n, start, longest=200):
    return [(start + i, source, " ".join("w" * rng.randrange(1, longest))) for i in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    rows = lots(rng, "hot", 3000, 0) + lots(rng, "b", 900, 10_000) + lots(rng, None, 40, 20_000) + lots(rng, "tiny", 3, 30_000)
    rows += [(40_000 + i, "one long", "w " * (4000 if i == 0 else 30)) for i in range(300)]
    return rows + [(50_000, "b", None), (50_001, "b", " \t\n"), (50_002, "empty", "")]


def test_targets_sizes_and_copies(spark, corpus):
    found = mixing.mixed(made(spark, corpus)).collect()
    assert len(found) == len(corpus)
    where, size = {i: s for i, s, _ in corpus}, {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, _, t in corpus}
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, n in size.items():
        sizes[where[i]] += n
    want = targets(sizes)
    for row in found:
        source = where[row.doc_id]
        assert row.size == size[row.doc_id] and row.source_size == sizes[source]
        assert row.target == pytest.approx(want[source])
        assert row.taken % max(row.size, 1) == 0 and 0 <= row.taken <= 3 * row.size
        taken[source] += row.taken
    for source, total in taken.items():
        assert abs(total - want[source]) <= max(0.01 * want[source], 1), source
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree_whatever_the_partitions(spark, corpus):
    table = made(spark, corpus)
    one = sorted(tuple(r) for r in mixing.mixed(table.repartition(1)).collect())
    other = sorted(tuple(r) for r in mixing.mixed(table.repartition(7)).withColumn("x", F.lit(1)).drop("x").collect())
    assert one == other


def test_every_document_is_taken_as_often_as_its_source_on_average(spark):
    """Over many corpora alike, rounding moves no document's expectation."""
    table = spark.range(40_000).select(
        F.lit(1).alias("one"), (F.col("id") % 8 + 1).alias("n"), F.floor(F.col("id") / 8).cast("string").alias("source"),
        F.col("id").alias("doc_id"),
    )
    table = table.select("doc_id", "source", F.repeat(F.lit("w "), F.col("n").cast("int")).alias("text"))
    found = mixing.mixed(table).groupBy("size", "target").agg(F.avg("taken").alias("t"), F.count("*").alias("n")).collect()
    for row in found:
        copies = row.target / 36
        spread = math.sqrt(0.25 * row["size"] ** 2 / row.n)
        assert abs(row.t - row["size"] * copies) < 5 * spread + 1e-9, row


def test_equal_rows_share_out_their_copies(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_AT_ONCE", 100)
    rows = [(1, "s", "a b")] * 500 + [(None, "s", "a b c")] * 300 + [(2, "t", "x " * 5000)]
    found = mixing.mixed(made(spark, rows)).collect()
    assert len(found) == 801
    of_s = [r for r in found if r.source_size == 1900]
    assert sum(r.taken for r in of_s) == pytest.approx(of_s[0].target, abs=3)
    assert len({r.taken for r in of_s if r.doc_id == 1}) <= 2


def test_no_words_no_rows_and_clashing_columns(spark):
    assert mixing.mixed(made(spark, [])).collect() == []
    none = mixing.mixed(made(spark, [(1, "a", None), (2, None, "  ")])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in none] == [(0, 0, 0.0, 0)] * 2
    table = made(spark, [(1, "a", "x y"), (2, "b", "z")])
    for name in ("size", "class", "block", "rank", "copies", "weight", "target", "salt"):
        table = table.withColumn(name, F.lit("q"))
    assert len(mixing.mixed(table).collect()) == 2


def test_words(spark):
    texts = ["", " ", "a", " a", "a ", " a\t\x0b b\r\n", None, "é x y", "\n\n", "a\x1fb"]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in table.select(mixing.words_in(F.col("t"))).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
