from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import functions as F

from tracebook.llm import merkle

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(*[field(value) for value in (row.doc_id, row.source, row.lang, row.n_chars, text)])


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][at : at + 16]) for at in range(0, len(found[-1]), 16)])
    return found


def climb(tree, at, digest):
    met = []
    for level in tree[:-1]:
        run, k = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
        met += run[:k] + run[k + 1 :]
        digest, at = h(*run[:k], digest, *run[k + 1 :]), at // 16
    return met, digest


def brute(rows):
    """One tuple per row, by lists in memory."""
    sources = {}
    for row in rows:
        own = leaf(row, row.text)
        hit = row.doc_id is not None and row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
        changed = leaf(row, row.text.translate(UPPER)) if hit else own
        order = (row.doc_id is not None, row.doc_id or 0, own)
        sources.setdefault(row.source, []).append((order, row.doc_id, own, changed))
    names = sorted(sources, key=lambda name: (name is not None, (name or "").encode()))
    trees = {name: levels([own for _, _, own, _ in sorted(sources[name])]) for name in names}
    top = levels([trees[name][-1][0] for name in names])
    for at, name in enumerate(names):
        for k, (_, doc_id, own, changed) in enumerate(sorted(sources[name])):
            below, digest = climb(trees[name], k, changed)
            above, digest = climb(top, at, digest)
            root = top[-1][0]
            yield doc_id, name, own, trees[name][-1][0], root, h(*below, *above), digest, digest == root


def result(table):
    found = merkle.manifest(table).select(
        "doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
    return sorted((tuple(row) for row in found.collect()), key=repr)


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_same_as_trees_in_memory(spark):
    rows = [(i, f"Text {i} ÉÄ K", "en", "hot", i) for i in range(300)]  # three levels
    rows += [(1000 + i, f"T{i}", None, f"s{i % 17}", None) for i in range(60)]  # more than 16 sources
    rows += [(2000, "LONE", "en", "zé", 4), (None, "Null ID", "en", None, 1), (2001, None, "en", None, 0), (2002, "", "", "", 0)]
    rows += [(5, "Text 5 ÉÄ K", "en", "hot", 5), (5, "other", "en", "hot", 5), (None, "Null ID", "en", None, 1)]
    table = made(spark, rows)
    found = result(table)
    assert found == sorted(brute(table.collect()), key=repr)
    assert {row[-1] for row in found} == {True, False}


def test_one_source_one_row_and_no_row(spark):
    for n in (1, 2, 16, 17):
        table = made(spark, [(i, f"Text {i}", "en", "one", i) for i in range(n)])
        assert result(table) == sorted(brute(table.collect()), key=repr)
    assert result(made(spark, [])) == []


def test_any_change_of_a_leaf_is_found_and_extra_columns_do_no_harm(spark):
    table = made(spark, [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(100)])
    table = table.withColumn("place", F.lit(1)).withColumn("tree", F.lit("x")).withColumn("run", F.lit(None))
    assert all(row.verified for row in merkle.manifest(table, F.lit(None).cast("boolean")).collect())  # nothing changed
    lower = table.withColumn("text", F.concat(F.lit("A"), "text"))
    assert not any(row.verified for row in merkle.manifest(lower, F.lit(True)).collect())


def test_very_long_text(spark):
    table = made(spark, [(7, "Ab " * 500_000, "en", "s", 1), (8, "b", "en", "s", 1)])
    assert result(table) == sorted(brute(table.collect()), key=repr)
