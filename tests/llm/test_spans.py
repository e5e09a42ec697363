from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from tracebook.llm import spans


def brute(rows, window):
    seen = Counter(tuple(w[i : i + window]) for _, w in rows for i in range(len(w) - window + 1))
    for doc_id, words in rows:
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        yield doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("period", sorted(spans.DIFFERENCE_SETS))
def test_difference_sets_align_every_shift(period):
    residues = spans.DIFFERENCE_SETS[period]
    assert {(a - b) % period for a in residues for b in residues} == set(range(period))


@pytest.mark.parametrize("window", [1, 3, 12, 35])
def test_removes_what_brute_force_removes(docs, window):
    rng = random.Random(window)
    passages = [[f"p{k}w{i}" for i in range(90)] for k in range(4)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(6)):
            words += [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(40))]
            start, size = rng.randrange(60), rng.randrange(3 * window)
            words += rng.choice(passages)[start : start + size]
        texts.append("  ".join(words))
    texts += ["a\x1cb é " * 50, texts[7], "", None, "x y"]
    found = spans.drop_repeated(docs(*texts).withColumn("row_key", spans.F.lit("clash")), window)
    rows = [(i, (t or "").encode().split()) for i, t in enumerate(texts)]
    wanted = list(brute([(i, [w.decode() for w in ws]) for i, ws in rows], window))
    assert sorted(tuple(r)[:4] for r in found.collect()) == sorted(wanted)


def test_null_ids_repeated_rows_and_empty_tables(docs):
    text = " ".join(str(i) for i in range(50))
    found = spans.drop_repeated(docs((None, text), (1, "short"), (2, text + " more"), (2, text + " more")))
    assert sorted((r.doc_id, r.n_removed) for r in found.collect() if r.doc_id) == [(1, 0), (2, 51), (2, 51)]
    assert [r.n_removed for r in found.collect() if r.doc_id is None] == [50]
    assert spans.drop_repeated(docs("x").limit(0)).collect() == []


def test_texts_without_an_id_are_told_apart_by_more_than_a_few_bits(docs):
    """Two texts whose hashes agree in the bits that mark a place; one has a repeated window, one has none."""
    seen, pair = {}, None
    for k in range(200_000):
        text = f"n{k} " + " ".join(f"c{i}" for i in range(3))
        bits = spans.xxhash.xxh3_64_intdigest(text.encode()) & ((1 << 62) - (1 << 40))
        if bits in seen:
            pair = seen[bits], text
            break
        seen[bits] = text
    one, other = pair
    # a window of the first is repeated by a third text, at places that the second has too
    third = "z " + one
    found = spans.drop_repeated(docs((None, one), (None, other), (1, third)), window=4).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == [(0, 0), (0, 4), (1, 4)]
