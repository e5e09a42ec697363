from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tracebook.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


TEXTS = [
    "", "  ", "a", " a b  c \n\n d\t e ", "it's we'll  I'd 've", "<|endoftext|> x", "end <|endoftext|> of", "a<|endoftext|><|endoftext|>", " <|endoftext|> b  c <|endof", "é ß 漢字 🙂 1234 ½ ²",
    "tab\tline\nnext  \n", "a b   c", "\x1c \x1d x", "word " * 3000, "x" * 5000, "ÀÉ, ñ-ó! " * 700,
]


def test_ids_are_those_of_the_tokenizer_file(tokenizer):
    encode = packing.Encoder(PATH).encode
    rng = random.Random(1)
    words = ["the", "tion", "é", "ß!", "12", "'s", "###", "a,b", "\n", "x\ny"]
    texts = TEXTS + [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(300)]
    for text in texts * 2:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_packs_hold_the_whole_histogram():
    rng = random.Random(2)
    histogram = {rng.randrange(1, 101): rng.randrange(1, 5000) for _ in range(80)}
    packs = packing.shortest_pack_first(histogram, 100)
    held = dict.fromkeys(histogram, 0)
    for count, lengths in packs:
        assert sum(lengths) <= 100
        for length in lengths:
            held[length] += count
    assert held == histogram


def test_every_token_lies_in_one_piece_and_sequences_have_no_gaps(docs, tokenizer):
    texts = TEXTS * 3 + [None]
    table = docs(*texts, (None, "no id"), (5, "again"), (5, "again"))
    found = packing.pack(table.withColumn("rank", table.doc_id), PATH, size=64).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in enumerate(texts):
        if doc_id == 5:
            continue
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        end = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == end and r.doc_tokens == len(ids)
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
            end += r.length
        assert end == len(ids)
    assert len(by_doc[None]) == 1 and len(by_doc[5]) == 3
    for run in by_sequence.values():
        end = 0
        for r in sorted(run, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 64
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_little_padding(docs):
    rng = random.Random(3)
    table = docs(*[" ".join(rng.choices(["the", "of", "and"], k=rng.randrange(900))) for _ in range(400)])
    found = packing.pack(table, PATH, size=512).collect()
    held = sum(r.length for r in found)
    assert held / (512 * len({r.sequence_id for r in found})) > 0.98


def test_empty_table(docs):
    assert packing.pack(docs("x").limit(0), PATH).collect() == []


def test_pieces_are_shuffled_once_into_few_partitions(spark, docs):
    held = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        table = docs(*["a b c " * n for n in range(300)], *["same text"] * 300, (None, "no id"))
        cut = packing.pieces(table, PATH, 64, 1)
        result = packing.ranked(cut, cut.count())
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan
        assert result.rdd.getNumPartitions() <= 8
        ranks = {}
        for row in result.collect():
            ranks.setdefault(row.length, []).append(row["rank"])
        assert all(sorted(found) == list(range(len(found))) for found in ranks.values())
        assert sum(map(len, ranks.values())) == cut.count()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
