from __future__ import annotations

import random

import pytest

from tracebook.llm import decontaminate


def words(rng, n):
    return ["".join(rng.choices("aeinorst", k=rng.randrange(2, 6))) for _ in range(n)]


def edited(rng, item, edits):
    item = list(item)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(max(len(item), 1))
        if kind == 0:
            item[at] = "changed"
        elif kind == 1:
            item.insert(at, "added")
        else:
            del item[at]
    return item


def fewest_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def bench(spark):
    rng = random.Random(1)
    items = [words(rng, rng.randrange(1, 70)) for _ in range(60)]
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    return rng, items, table


def test_recall_and_precision_against_all_pairs(docs, bench):
    rng, items, table = bench
    texts = []
    for _ in range(250):
        item = rng.choice(items)
        body = edited(rng, item, rng.randrange(len(item) // 4 + 2))
        texts.append([*words(rng, rng.randrange(60)), *body, *words(rng, rng.randrange(60))])
    shown = [rng.choice([" ", "  ", "\n", "!! "]).join(w.title() if rng.random() < 0.3 else w for w in t) for t in texts]
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contained_items(docs(*shown), table).collect()}
    wanted = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            if len(set(text) & set(item)) >= 0.5 * len(set(item)):
                edits = fewest_edits(item, text)
                if edits <= int(0.2 * len(item) + 1e-9):
                    wanted[d, i] = edits
    assert found.keys() <= wanted.keys()
    assert len(found) >= 0.95 * len(wanted)
    assert all(found[pair].edits >= wanted[pair] for pair in found)
    exact = {pair for pair, edits in wanted.items() if edits == 0}
    assert exact <= found.keys()


def test_edits_within_is_the_fewest_over_all_windows():
    import numpy as np

    rng = random.Random(2)
    for _ in range(200):
        item = [rng.randrange(5) for _ in range(rng.randrange(1, 8))]
        text = [rng.randrange(5) for _ in range(rng.randrange(12))]
        assert decontaminate.edits_within(np.array(item), np.array(text)) == fewest_edits(item, text)


def test_very_long_texts_and_filter(docs, bench):
    rng, items, table = bench
    long = [*words(rng, 60_000), *items[5], *words(rng, 60_000)]
    clean = " ".join(f"q{i}" for i in range(5000))
    table2 = docs(" ".join(long), clean, None, "", (None, " ".join(items[9])), (1, clean)).withColumnRenamed("lang", "item_id")
    kept = decontaminate.without_items(table2, table)
    assert kept.columns == table2.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "2", "3"]


def test_empty_tables_null_and_wordless_items(docs, spark):
    none = spark.createDataFrame([(1, None), (2, "!! ?"), (None, "abc def")], "item_id long, text string")
    assert [tuple(r)[:2] for r in decontaminate.contained_items(docs("x abc def y", "ab"), none).collect()] == [(0, None)]
    assert decontaminate.contained_items(docs("x"), none.limit(0)).collect() == []
    assert decontaminate.contained_items(docs("x").limit(0), none).collect() == []


def test_long_items_with_all_the_edits_allowed_are_found(docs, spark):
    rng = random.Random(11)
    items = [words(rng, 500) for _ in range(4)]
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    # every fifth word replaced: no five words of the item are left in a row
    texts = [["changed" if (at + k) % 5 == 0 else w for at, w in enumerate(items[k % 4])] for k in range(40)]
    shown = [" ".join([*words(rng, k), *text, *words(rng, 9)]) for k, text in enumerate(texts)]
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contained_items(docs(*shown), table).collect()}
    assert found.keys() == {(k, k % 4) for k in range(40)}
    assert all(r.edits <= 100 for r in found.values())
