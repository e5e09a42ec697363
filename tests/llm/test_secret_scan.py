from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracebook.llm import secret_scan
from tracebook.llm.common import table

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
PROSE = "the report names what the company has done in the year and what it means to do next "


def draw(rng, letters, size):
    return "".join(rng.choices(letters, k=size))


@pytest.fixture(scope="module")
def scanner(spark):
    return secret_scan.fitted(table(spark, "/root/testdata/sf0.01", "documents"))


def found(scanner, text):
    data = text.encode()
    return [data[s:e].decode() for s, e, _ in scanner.scan(data)]


KINDS = {
    "bare_akia": lambda r: ("see {} there", "AKIA" + draw(r, LETTERS[:26] + LETTERS[52:], 16)),
    "bare_ghp": lambda r: ("{}", "ghp_" + draw(r, LETTERS, 36)),
    "url": lambda r: ("https://user:{}@host.example/x", "ghp_" + draw(r, LETTERS, 36)),
    "bearer": lambda r: ("Authorization: Bearer {}", draw(r, LETTERS, 40)),
    "unquoted": lambda r: ("password={} ", draw(r, LETTERS, 12) + "7"),
    "quoted": lambda r: ('api_key = "{}"', draw(r, LETTERS, 32)),
    "long": lambda r: ('secret: "{}"', draw(r, LETTERS + "+/", 400)),
}
LOOK_ALIKES = {
    "git": lambda r: ("commit {}", draw(r, "0123456789abcdef", 40)),
    "uuid": lambda r: ("id: {}", "-".join(draw(r, "0123456789abcdef", n) for n in (8, 4, 4, 4, 12))),
    "path": lambda r: ("https://host.example/{}", "/".join(r.choices(["usr", "lib", "main", "v2", "src", "assets"], k=6))),
    "word": lambda r: ("the password: {} ", r.choice(["nothing", "required", "whatever", "optional"])),
}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_secrets_are_found_where_they_stand(scanner, kind):
    rng = random.Random(kind)
    hits = 0
    for _ in range(40):
        form, value = KINDS[kind](rng)
        hits += value in found(scanner, PROSE + form.format(value) + " " + PROSE)
    assert hits >= 36


@pytest.mark.parametrize("kind", sorted(LOOK_ALIKES))
def test_look_alikes_are_left(scanner, kind):
    rng = random.Random(kind)
    hits = 0
    for _ in range(40):
        form, value = LOOK_ALIKES[kind](rng)
        hits += bool(found(scanner, PROSE + form.format(value) + " " + PROSE))
    assert hits <= 2


def test_query_is_the_scan_of_every_text(docs, scanner):
    rng = random.Random(4)
    secret = "ghp_" + draw(rng, LETTERS, 36)
    texts = [f"é {PROSE} token = \"{secret}\" and {secret}", None, "", PROSE * 5000 + secret, PROSE]
    df = docs(*texts, (0, texts[0]), (None, texts[0]))
    for name in ("start", "length", "secret", "score", "path", "hash"):
        df = df.withColumn(name, F.lit("x"))
    want = []
    for row in df.collect():
        data = (row.text or "").encode()
        for s, e, score in scanner.scan(data):
            want.append((row.doc_id, len(data[:s].decode()), len(data[s:e].decode()), data[s:e].decode(), score))
    got = [tuple(r) for r in secret_scan.secrets(df, scanner).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[3] == secret for r in got) == 7
    masked = secret_scan.without_secrets(df, scanner)
    assert masked.columns == df.columns and masked.count() == 7
    assert not [r for r in masked.collect() if r.text and secret in r.text]
    assert secret_scan.secrets(df.limit(0), scanner).collect() == []


def test_sample_is_bounded_whatever_repeats(docs):
    df = docs(*[f"text {i} x = 'y'" for i in range(50)], *[(7, "same text")] * 300, (1, None), (2, ""))
    texts = secret_scan.sample_texts(df, 20, 1000)
    assert len(texts) == 11 and texts == secret_scan.sample_texts(df.repartition(5), 20, 1000)
    assert secret_scan.sample_texts(df.limit(0), 20, 1000) == []


def test_labelled_rows_are_bounded_when_an_id_repeats(spark, docs):
    from tracebook.llm.labelled import chosen_rows

    df = docs(*[(7, f"text {i}") for i in range(400)], *[(i, "t") for i in range(20, 40)], (7, "text 1"), (None, "t"))
    labels = spark.createDataFrame([(7, 1), (7, 1), (7, 0), *[(i, 0) for i in range(20, 40)]], "doc_id long, quality int")
    rows = chosen_rows(df, labels, "quality", F.lit(True), 30).collect()
    assert len({(r.doc_id, r.text, r.label) for r in rows}) == len(rows)
    assert sum(r.label == 1 for r in rows) == 30 and sum(r.label == 0 for r in rows) == 30


def test_dictionary_and_labels_come_from_all_documents(docs):
    rng = random.Random(5)
    named = [f'{PROSE} token = "{draw(rng, LETTERS, 32)}" and commit {draw(rng, "0123456789abcdef", 40)} ' for _ in range(300)]
    long = (PROSE * 300 + "zymurgy Überzählig ") * 3 + f'secret: "{draw(rng, LETTERS, 24)}1"'
    df = docs(*named, *named[:20], long, None, "", "a1 bc\ndef").repartition(7)
    texts = [r.text.encode() for r in df.collect() if r.text]
    counts = {bytes(r.word): r.n for r in secret_scan.word_counts(df).collect()}
    want = Counter(w for t in texts for w in re.findall(rb"[a-z\x80-\xff]{3,}", t.lower()))
    assert counts == want
    found = [(bytes(r.near), r.start, r.end, r.label) for r in secret_scan.named_findings(df).collect()]
    assert len(found) == 601 and set(found) == set(secret_scan.seed_findings(texts))
    scanner = secret_scan.fitted(df)
    assert b"zymurgy" in scanner.around.words
    assert secret_scan.fitted(df.repartition(3)) == scanner


def test_dictionary_takes_equally_frequent_words_together(spark):
    counts = spark.createDataFrame([(b"aaa", 9), (b"bbb", 5), (b"ccc", 5), (b"ddd", 1)], "word binary, n long")
    for most, words in ((4, 4), (3, 3), (2, 1), (1, 1), (0, 0)):
        around, total = secret_scan.dictionary(counts, most)
        assert (len(around.words), total) == (words, 20)


def test_no_documents_leave_the_generated_findings(docs):
    scanner = secret_scan.fitted(docs("x").limit(0))
    assert found(scanner, 'api_key = "' + "Ab3" * 12 + '"')


def test_query_takes_no_sample(spark, monkeypatch):
    from tracebook.llm.queries import QUERIES

    monkeypatch.setattr(secret_scan, "sample_texts", None)
    assert QUERIES["op7_secret_scan"](spark, "/root/testdata/sf0.001").columns == ["doc_id", "start", "length", "secret", "score"]


def test_stage_of_the_pipeline_takes_no_sample(spark, docs, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(secret_scan, "sample_texts", None)
    secret = "ghp_" + draw(random.Random(6), LETTERS, 36)
    rows = corpus_pipeline.mask_secrets(spark, docs(PROSE * 300 + f'token = "{secret}" ', PROSE, None), "").collect()
    texts = {r.doc_id: r.text for r in rows}
    assert secret not in texts[0] and texts[0].startswith(PROSE) and texts[1] == PROSE and texts[2] is None
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
