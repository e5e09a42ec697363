from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracebook.llm import collocations

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id long, text string, lang string"


def brute(rows, words=3, min_count=10, share=50, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            found = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(found)
            for n in range(1, words + 1):
                for at in range(len(found) - n + 1):
                    counts[lang][tuple(found[at : at + n])] += 1
    result = set()
    for lang, f in counts.items():
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {q for p, a in known.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= share * f[q]}
        scored = []
        for p, a in known.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.add((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return result


def made(spark, rows):
    return spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(rows)], DOC)


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "d\x1f", "E'e", "\U0001f600", "x-y", "K", "\x00", "und"] + [f"r{i}" for i in range(200)]
    weights = [30] * 10 + [1] * 200
    for _ in range(n):
        text = "".join(w + rng.choice(["  ", " ", "\t", ". ", ",", "\n", "\x0b"]) for w in rng.choices(words, weights, k=80))
        yield rng.choice(["en", "EN", None, "und", "", "a b", "t\tb"]), text


@pytest.mark.parametrize("words,share,top", [(3, 50, 2000), (2, 50, 2000), (3, 10, 20), (3, 90, 1)])
def test_same_as_counting_every_phrase(spark, words, share, top):
    rows = [*corpus(), ("en", None), ("en", ""), (None, "..,"), ("xx", "one two")] + [("cp", "the same long text , again")] * 12
    found = collocations.collocations(made(spark, rows), words, 10, share, top).collect()
    assert {tuple(r) for r in found} == brute(rows, words, 10, share, top) and len(found) == len(set(found))


def test_runs_handed_on_early_and_cut_texts_count_the_same(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 50)
    numbers = collocations.Numbers({b".": 0})
    text = ("One two, three " * 40 + "word" * 60 + " end").encode()
    flat = np.concatenate(collocations.word_numbers(text, numbers))
    plain = collocations.Numbers({b".": 0})
    monkeypatch.setattr(collocations, "SLICE_BYTES", 1 << 20)
    assert flat.tolist() == np.concatenate(collocations.word_numbers(text, plain)).tolist() and numbers == plain
    few, n = collocations.distinct_windows(flat, 3, len(numbers))
    many, m = collocations.distinct_windows(flat, 3, 1 << 22)
    assert few.tolist() == many.tolist() and n.tolist() == m.tolist()


def test_small_runs_add_up(spark, monkeypatch):
    rows = list(corpus(2, 60))
    batches = [collocations.pa.RecordBatch.from_pydict({"lang": ["x"] * len(rows), "text": [t for _, t in rows]})]
    whole, parts = Counter(), Counter()
    for limit, sums in ((10**9, whole), (100, parts)):
        monkeypatch.setattr(collocations, "WORDS_AT_ONCE", limit)
        for batch in collocations._count(3)(batches):
            for row in batch.to_pylist():
                sums[row["key"]] += row["n"]
    assert whole == parts


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000
    rows = [("en", "a", 1, big + 7), ("en", "b", 1, big + 1), ("en", "a b", 2, big), ("en", None, 0, 1)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    (row,) = collocations.scored_phrases(counts, 2).collect()
    assert row.score == 1_000_000 * big * big // ((big + 7) * (big + 1))


def test_empty_table_clashing_columns_and_bad_lengths(spark):
    table = made(spark, [("en", "a b " * 20)])
    assert collocations.collocations(table.limit(0)).collect() == []
    for name in ("n", "head", "last", "words", "rank", "phrase", "part", "score"):
        table = table.withColumn(name, F.lit("q"))
    assert {tuple(r) for r in collocations.collocations(table).collect()} == brute([("en", "a b " * 20)])
    with pytest.raises(ValueError):
        collocations.collocations(table, words=4)


def test_windows_are_shuffled_once(spark):
    """Counts and sums of windows stay where the words before the last have brought them."""
    counts = collocations.phrase_counts(made(spark, [("en", "a b c")]))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    # windows, what is left of them after rare endings, the ROLLUP
    assert plan.count("Exchange hashpartitioning") == 3
