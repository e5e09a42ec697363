"""Token sequences of a fixed size: shortest-pack-first over the histogram of piece lengths.

Documents are tokenized once. A document longer than a sequence gives full sequences and one
rest; the histogram of piece lengths has one bin per possible length, so it is as small for 100
TB as for a test. Packing works on bins: lengths are placed longest first, each on the shortest
packs it still fits on, and every step moves a whole count of equal packs. The result says which
ranks of each length go to which sequences, and pieces find their place by their rank.

Ranks do not need one task per length: pieces are counted per length and bucket, the counts are
summed up over buckets, and rows are numbered within their bucket. The sum before a bucket comes
to its pieces as one more row, so that they are shuffled and sorted once.
"""

from __future__ import annotations

import array
import heapq
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracebook.llm.common import run_starts, stored

LONE_SPACES = re.compile(r"^ | $| (?=\s)|(?<=\s) ")
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORDS_KEPT = 200_000
ROWS_PER_BUCKET = 200_000
ROWS_PER_PARTITION = 20_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def byte_level_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE tokenizer file, as bytes.

    Such files write a byte as itself if it prints, and else as the next character from 256 on.
    """
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printing]
    byte = {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    added = added_tokens(path)
    return {
        bytes(byte[c] for c in token): rank
        for token, rank in vocabulary.items()
        if all(c in byte for c in token) and token not in added
    }


def added_tokens(path: str) -> dict[str, int]:
    """Tokens that the file adds to the vocabulary: found in a text as a whole, before anything is split."""
    with open(path, encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file).get("added_tokens", [])}


class Encoder:
    """Ids of whole texts; words met before are looked up.

    A space between two characters that are no white space always starts a token, so a text
    without other spaces can be cut there, word by word, without changing its ids.
    """

    def __init__(self, path: str):
        self.added = added_tokens(path)
        self.model = tiktoken.Encoding(
            "from file", pat_str=PATTERN, mergeable_ranks=byte_level_ranks(path), special_tokens=self.added
        )
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.ends = array.array("I"), array.array("q", [0])

    def add(self, word: str) -> int:
        self.flat.extend(self.model.encode_ordinary(" " + word))
        self.ends.append(len(self.flat))
        self.place[word] = len(self.ends) - 2
        return self.place[word]

    def encode(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added):
            return np.array(self.model.encode(text, allowed_special="all"), np.uint32)
        if LONE_SPACES.search(text):
            return np.array(self.model.encode_ordinary(text), np.uint32)
        first, *words = text.split(" ")
        if len(self.place) > WORDS_KEPT:
            self.forget()
        place, add = self.place, self.add
        codes = [place[w] if w in place else add(w) for w in words]
        head = np.array(self.model.encode_ordinary(first), np.uint32)
        if not codes:
            return head
        codes = np.array(codes, np.int64)
        ends = np.frombuffer(self.ends, np.int64)
        starts, sizes = ends[codes], ends[codes + 1] - ends[codes]
        at = np.repeat(starts - run_starts(sizes), sizes) + np.arange(int(sizes.sum()))
        return np.concatenate((head, np.frombuffer(self.flat, np.uint32)[at]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _pieces(path: str, size: int, end_id: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece), len(ids)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return emit


def pieces(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """Every document's ids and ``end_id``, cut after each ``size`` ids."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(_pieces(path, size, end_id), PIECES)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packs as (count, lengths): longest lengths first, each on the shortest packs it fits on."""
    packs: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    filled: list[int] = []  # heap of the totals in ``packs``

    def add(total: int, count: int, lengths: tuple[int, ...]) -> None:
        if total not in packs:
            packs[total] = []
            heapq.heappush(filled, total)
        packs[total].append((count, lengths))

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        while todo:
            total = filled[0] if filled else size
            if total + length > size:
                add(length, todo, (length,))
                break
            count, lengths = packs[total].pop()
            if not packs[total]:
                del packs[total]
                heapq.heappop(filled)
            taken = min(count, todo)
            if taken < count:
                add(total, count - taken, lengths)
            add(total + length, taken, (*lengths, length))
            todo -= taken
    return [pack for total in sorted(packs, reverse=True) for pack in packs[total]]


def slots(packs: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """(length, first rank, first sequence, offset) per place of a pattern, by length and rank."""
    ranks: dict[int, int] = {}
    found, sequence = [], 0
    for count, lengths in packs:
        offset = 0
        for length in lengths:
            rank = ranks.get(length, 0)
            found.append((length, rank, sequence, offset))
            ranks[length] = rank + count
            offset += length
        sequence += count
    return np.array(sorted(found), np.int64).reshape(-1, 4)


def _placed(table: np.ndarray):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.append(np.searchsorted(table[:, 0], np.unique(table[:, 0])), len(table))
        lengths = np.unique(table[:, 0])
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            at = np.zeros(len(length), np.int64)
            for value in np.unique(length):
                here = length == value
                low = starts[np.searchsorted(lengths, value)]
                high = starts[np.searchsorted(lengths, value) + 1]
                at[here] = low + np.searchsorted(table[low:high, 1], rank[here], side="right") - 1
            sequence = table[at, 2] + rank - table[at, 1]
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(table[at, 3])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return emit


def ranked(cut: DataFrame, rows: int) -> DataFrame:
    """Pieces with a rank from 0 among those of their length, numbered bucket by bucket."""
    buckets = max(64, -(-rows // ROWS_PER_BUCKET))
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets))
    dealt = cut.withColumn("bucket", bucket)
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    rows_and_shifts = dealt.unionByName(shifts, allowMissingColumns=True)
    # the row with the shift is the first of its length and bucket
    within = Window.partitionBy("length", "bucket").orderBy(F.col("shift").asc_nulls_last(), "doc_id", "start", "ids_crc32")
    return (
        rows_and_shifts.withColumn("rank", F.first("shift").over(within) + F.row_number().over(within) - 2)
        .where(F.col("shift").isNull())
        .drop("bucket", "shift")
        .coalesce(max(8, -(-rows // ROWS_PER_PARTITION)))
    )


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """Sequences of at most ``size`` tokens that hold every token of every document once.

    ``docs``: doc_id, text; other columns are not read. A document is its ids by the byte-level
    BPE file ``tokenizer`` and then ``end_id``; a null or empty text is ``end_id`` alone. Returns
    per piece: doc_id, start, length, ids_crc32 (little-endian 32-bit ids), doc_tokens,
    sequence_id, offset; offsets of a sequence follow each other without gaps from 0. Rows that
    are repeated are packed as often as they come; a null doc_id keeps its pieces. An empty table
    gives an empty result.
    """
    if size < 1:
        raise ValueError("size must be positive")
    cut = stored(pieces(docs, tokenizer, size, end_id))
    # at most ``size`` bins, whatever the input
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(shortest_pack_first(histogram, size))
    return ranked(cut, sum(histogram.values())).mapInArrow(
        _placed(table), f"{PIECES}, sequence_id long, offset long"
    )
