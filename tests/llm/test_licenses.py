from __future__ import annotations

import random
import re
import textwrap

from pyspark.sql import functions as F

from tracebook.llm import licenses

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(text, templates, threshold):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(WORD, text)
    starts, base, labels, score = [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        places = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += places
        base |= {label} if places else set()
    for template, label in templates:
        want, wide = set(template.split()), int(len(template.split()) / threshold + 1e-9)
        for at in range(len(words)):
            share = len(set(words[at : at + wide]) & want)
            if share >= threshold * len(want) - 1e-9:
                labels.add(label)
                score = max(score, share / len(want))
    first, last = (min(starts), max(starts)) if starts else (None, None)
    joined = ",".join(sorted(base | labels))
    return len(words), len(starts), first, last, ",".join(sorted(base)), joined, 1.0 if starts else score


def test_same_as_comparing_every_block_with_every_template(docs):
    rng = random.Random(8)
    vocabulary = sorted({w for t, _ in licenses.TEMPLATES for w in t.split()}) + ["é", "x1", "K"]
    texts = [t for t, _ in licenses.TEMPLATES]
    for _ in range(150):
        words = rng.choice(licenses.TEMPLATES)[0].split()
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.5:
            rng.shuffle(words)
        texts.append(rng.choice([" ", "-", ", ", "\n"]).join(words).title())
    texts += ["Licensed under CC BY-NC 4.0.", "cc by\nnc", "UNDER the MIT license under the mit LICENSE", "", None, "mit mit"]
    table = docs(*texts).withColumn("row_key", F.lit("x")).withColumn("word", F.lit("y"))
    found = {r.doc_id: tuple(r)[1:] for r in licenses.license_labels(table).collect()}
    for i, text in enumerate(texts):
        assert found[i] == brute(text, licenses.TEMPLATES, 0.8), text


def test_null_ids_repeated_rows_and_empty_tables(docs):
    found = licenses.license_labels(docs((None, "All rights reserved."), (1, "cc by nc"), (1, "cc by nc"))).collect()
    assert sorted((r.doc_id or 0, r.labels) for r in found) == [(0, "all-rights-reserved"), (1, "cc-by-nc"), (1, "cc-by-nc")]
    assert licenses.license_labels(docs("x").limit(0)).collect() == []


NOTICE = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
)


def test_notices_wrapped_and_in_comments(docs):
    wrapped = textwrap.wrap(NOTICE, 72)
    filler = "vu lo ma " * 500
    texts = [
        "\n".join(wrapped), "\n".join(f"// {line}" for line in wrapped), "\r\n".join(f" * {line}" for line in wrapped),
        filler + "\n".join(f"# {line}" for line in wrapped) + filler, NOTICE[:90], filler,
        " permission ".join(filler.split(" ")), "rights (reserved), all", "all of your own rights reserved",
    ]
    found = {r.doc_id: (r.labels, r.score) for r in licenses.license_labels(docs(*texts)).collect()}
    assert [found[i][0] for i in range(9)] == ["mit"] * 4 + [""] * 3 + ["all-rights-reserved", ""]
    assert found[0][1] == 1.0 and found[3][1] == 1.0


def test_blocks_anywhere_in_long_texts(docs):
    """Notices at every place of a span, so that each lies in one whole."""
    notice = licenses.TEMPLATES[2][0]
    texts = ["x " * n + notice + " y" * 30 for n in range(0, 90, 7)] + ["the of to " * 20_000 + notice]
    found = licenses.license_labels(docs(*texts)).collect()
    assert {(r.labels, r.score) for r in found} == {("mit", 1.0)}
