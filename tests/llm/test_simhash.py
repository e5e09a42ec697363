from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tracebook.llm import components, simhash


def brute(codes, limit):
    """Smallest reachable code of each, by comparing all pairs."""
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= limit
    label = np.arange(len(codes))
    for _ in range(len(codes)):
        nxt = np.where(near, label[None, :], len(codes)).min(axis=1)
        if (nxt == label).all():
            return label
        label = nxt
    return label


def groups(pairs, codes):
    label = {int(c): int(c) for c in codes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        label[find(int(a))] = find(int(b))
    return [find(int(c)) for c in codes]


@pytest.mark.parametrize("size,spread", [(3, 2), (60, 3), (400, 4), (700, 20)])
def test_spanning_links_hold_the_same_sets_together_as_all_pairs(size, spread):
    rng = np.random.default_rng(size)
    centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 40, (size, spread), dtype=np.uint64)
    codes = np.unique(centres[rng.integers(0, 5, size)] ^ np.bitwise_xor.reduce(flips, axis=1))
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    codes = codes[np.argsort(rank)]
    found = groups(zip(*simhash.spanning_links(codes, 2), strict=True), codes)
    wanted = brute(codes, 2)
    assert len({*zip(found, wanted.tolist(), strict=True)}) == len(set(found)) == len(set(wanted.tolist()))


def test_masks_catch_every_two_differing_bits():
    for a in range(64):
        for b in range(a + 1):
            assert any(not (mask >> a & 1 or mask >> b & 1) for mask in simhash.masks())


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = dict(components.components(spark.createDataFrame(links, "left long, right long")).collect())
    assert {found[i] for i in range(41)} == {0}
    assert {found[100 + i] for i in range(30)} == {100}


def test_near_copies_nulls_ties_and_empty_texts(docs):
    long = " ".join(f"word{i}" for i in range(400))
    table = docs((5, long), (3, long.upper()), (9, long + " tail"), (9, long + " tail"), (4, None), (6, ""), (7, "a B"),
                 (8, "A b"), (None, long))
    found = sorted(simhash.near_copies(table.withColumn("code", table.source)).collect(), key=repr)
    assert len(found) == 9
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].component_id for i in (3, 5, None)} == {3}
    assert by_id[4].component_id == by_id[6].component_id == 4
    assert by_id[4].fingerprint == "0" * 16
    assert by_id[7].fingerprint == f"{xxhash.xxh64_intdigest(b'a b', 42):016x}"
    assert by_id[8].component_id == 7


def test_empty_table(docs):
    assert simhash.near_copies(docs((1, "x")).limit(0)).collect() == []


def test_masks_catch_more_differing_bits():
    import random

    rng = random.Random(3)
    for limit in (3, 4, 6, 8):
        for _ in range(300):
            bits = rng.sample(range(64), limit)
            assert any(not any(mask >> bit & 1 for bit in bits) for mask in simhash.masks(limit))


def test_one_of_each_group_of_near_copies_stays(docs):
    import random

    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choices(words, k=rng.randrange(40, 400)) for _ in range(60)]
    rows, groups = [], []
    for g, text in enumerate(base):
        for copy in range(g % 4 + 1):
            changed = list(text)
            if copy:
                changed[rng.randrange(len(changed))] = "other"
            rows.append(" ".join(changed))
            groups.append(g)
    order = rng.sample(range(len(rows)), len(rows))
    table = docs(*[(i, rows[i]) for i in order], (900, None), (901, ""), (902, "a b"), (902, "a b"), (None, rows[0]))
    kept = simhash.one_of_each(table)
    assert kept.columns == table.columns
    ids = sorted(r.doc_id for r in kept.collect())
    first = [groups.index(g) for g in range(60)]
    assert set(first) <= set(ids) and ids[-2:] == [900, 902]
    assert len(ids) <= 60 + 2 + 4
    assert simhash.one_of_each(table.limit(0)).collect() == []


def test_links_of_a_wide_node_are_those_of_all_close_and_similar_pairs(spark):
    """60 codes of one node; S is close to all and similar to none, the others are similar in pairs."""
    rng = np.random.default_rng(7)
    codes = np.array([0, *[1 << (i % 16) | 1 << (16 + i // 16) for i in range(60)]], np.int64)
    sketches = rng.integers(0, 0xFFFF, (61, simhash.BINS)).astype(np.uint16)
    for i in range(1, 61, 2):
        sketches[i + 1] = sketches[i]
        sketches[i + 1, :20] = 1
    rows = [(i, int(codes[i]), bytearray(sketches[i].tobytes())) for i in range(61)]
    entries = spark.createDataFrame(rows, "entry long, code long, sketch binary")
    found = groups(((r.left, r.right) for r in simhash.similar_links(entries, 6, 0.8).collect()), range(61))
    assert len({*found}) == 31
    assert all(found[i] == found[i + 1] for i in range(1, 61, 2))


def test_different_texts_of_one_fingerprint_both_stay(docs):
    """Both texts have the same runs of two words, but few runs of five in common."""
    import random

    rng = random.Random(8)
    blocks = [f"h {' '.join(f'b{k}x{i}' for i in range(4))} " for k in range(60)]
    one = "".join(rng.sample(blocks, 60)) + "h"
    other = "".join(rng.sample(blocks, 60)) + "h"
    assert sorted(simhash.shingles(one.encode(), 2)) == sorted(simhash.shingles(other.encode(), 2))
    assert {r.doc_id for r in simhash.one_of_each(docs(one, other, one)).collect()} == {0, 1}


def test_one_per_component_is_that_of_all_pairs(docs):
    import random

    rng = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    texts = []
    for g in range(60):
        text = rng.choices(words, k=rng.randrange(3, 500))
        texts += [" ".join(text)] * (1 + g % 3) + [" ".join([*text, "tail"])] * (g % 2)
    order = rng.sample(range(len(texts)), len(texts))
    rows = [(i, texts[i]) for i in order]
    table = docs(*rows, (900, None), (901, ""), (902, "a b"), (902, "a b"), (902, "c d"), (None, texts[0]), (None, "x"))
    table = table.withColumn("key", table.text).withColumn("first", table.lang)
    kept = simhash.one_per_component(table)
    assert kept.columns == table.columns
    prints = {r.doc_id: r.code % 2**64 for r in simhash.fingerprints(docs(*rows)).collect()}
    pairs = ((a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2)
    of: dict = {}
    for i, root in enumerate(groups(pairs, range(len(texts)))):
        of.setdefault(root, i)
    expected = {*of.values()}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert {i for i, _ in got if i is not None and i < 900} == expected
    assert sorted((i or -1, t) for i, t in got if i is None or i >= 900) == [
        (-1, "x"), (900, None), (902, "a b"), (902, "c d"),
    ]
    assert simhash.one_per_component(table.limit(0)).collect() == []
