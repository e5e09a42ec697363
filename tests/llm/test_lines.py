from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tracebook.llm import lines
from tracebook.llm.common import stored


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    rows = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(rows) - len(set(rows)), len(again), failed


def test_counts_of_odd_texts(docs):
    rng = random.Random(4)
    texts = ["", None, " \n\t", "é b 漢 🙂 #*$", "a\n\na\n b\nb \r\n a", "x " * 8, "x " * 9, "a b c d e f g h " * 3]
    texts += [" ".join(rng.choices("abc", k=rng.randrange(200))) for _ in range(20)]
    texts += ["one two three four five six seven eight nine " + "w " * 5 + "one two three four five six seven eight"]
    table = docs(*texts).withColumn("lines", F.lit(1)).withColumn("row_key", F.lit(1))
    found = {r.doc_id: r for r in lines.line_verdicts(table).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(text), repr(text)


def body(rng, k):
    return "\n".join(" ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(12)) for _ in range(k))


def test_furniture_is_dropped_per_host_and_depleted_documents_are_rejected(docs):
    rng = random.Random(5)
    menu = "Home  About CONTACT 2024 and many other words that fill the line of a menu here"
    other = menu.lower().replace("2024", "7")
    clean = [body(rng, 5) + "\n" + (menu if i % 2 else other) for i in range(30)]
    poor = [f"{menu}\n{menu} \nx{i} y z u v w" for i in range(3)]
    table = docs(*clean, *poor).withColumn("source", F.lit("a"))
    there = docs(*[(100 + i, body(rng, 2) + "\n" + menu) for i in range(5)]).withColumn("source", F.lit("b"))
    found = {r.doc_id: r for r in lines.line_verdicts(table.union(there), max_share=0.5).collect()}
    assert all(found[i].kept and found[i].n_own_words == 60 for i in range(30))
    assert [found[30 + i].kept for i in range(3)] == [False] * 3
    assert all(found[100 + i].kept and found[100 + i].n_own_words == found[100 + i].n_words for i in range(5))


def test_copies_count_as_one_document(docs):
    rng = random.Random(6)
    text = body(rng, 6)
    copies = [text] * 40 + [text.replace("a", "v", 1) for _ in range(3)]
    assert all(r.kept for r in lines.line_verdicts(docs(*copies)).collect())


def test_without_lines_gives_the_text_that_is_left(docs):
    rng = random.Random(7)
    table = docs(*[f"Same line here\n{body(rng, 2)}\nsame  line HERE" for _ in range(30)])
    rows = stored(lines.measured(table, "source"))
    left = lines.without_lines(table, lines.furniture(rows, lines.frequent_lines(rows, 5, 0.5)))
    assert left.columns == table.columns
    assert all("ame line" not in r.text and r.text.count("\n") == 1 for r in left.collect())


def test_null_hosts_repeated_rows_and_empty_tables(docs):
    table = docs((1, "a " * 30), (1, "a " * 30), (None, None)).withColumn("source", F.lit(None).cast("string"))
    found = lines.line_verdicts(table).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in found) == [(0, 0), (1, 30), (1, 30)]
    assert lines.line_verdicts(table.limit(0)).collect() == []
