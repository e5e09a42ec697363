"""Repeated passages: every window of N words that starts at two places, word for word.

Difference-cover anchors. A perfect difference set D modulo V has, for any two positions, one
shift below V that takes both into D. So when two places agree over ``window`` words, a run of
``window - V + 1`` words at cover positions of both agrees too. Only those runs, |D| / V of all,
are hashed and shuffled; from each anchor that comes twice the match is extended to the whole
windows around it, which meet under a hash of 96 bits.

Nothing is gathered per hash: rows are sorted by hash and read as a stream. A map task emits a
hash once per chunk of text; what repeats inside the chunk is known there already. A passage
that a third of all documents share thus sends one row per chunk, not one per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracebook.llm.common import Memo, byte_texts, chunks, positions_within, run_starts, signed

# Perfect difference sets (Singer), by modulus: every residue but zero is one difference.
DIFFERENCE_SETS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D)
# A text is named by 64 bits of hash over its id, whether that is null, and the text. A place of it
# is one long: 40 bits of word position, then 23 bits of another hash of the text. The sign marks
# runs that are known as repeated.
PLACE_BITS = 40
PLACE = (1 << PLACE_BITS) - 1
TEXT_BITS = (1 << 63) - 1 - PLACE
KNOWN = 1 << 63
ANCHORS = "hash long, name long, mark long"
WINDOWS = "hash long, extra int, name long, mark long"
# A run of places in a text is one long: the first place, then 32 bits for its length.
FOUND = "name long, text_mark long, places long"
RUN_BITS = 32


def cover(window: int) -> tuple[int, tuple[int, ...]]:
    """The widest difference cover that leaves anchors of a third of the window at least."""
    fit = [v for v in DIFFERENCE_SETS if window - v + 1 >= max(window // 3, 1)]
    return (max(fit), DIFFERENCE_SETS[max(fit)]) if fit else (1, (0,))


class Rolling:
    """Polynomial hashes of all windows of one size over concatenated word hashes."""

    def __init__(self, multiplier: int, words: np.ndarray):
        with np.errstate(over="ignore"):
            powers = np.full(len(words) + 1, multiplier, np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers, dtype=np.uint64)
            self.back = np.full(len(words) + 1, pow(multiplier, -1, 1 << 64), np.uint64)
            self.back[0] = 1
            self.back = np.cumprod(self.back, dtype=np.uint64)
            self.sums = np.concatenate(
                (np.zeros(1, np.uint64), np.cumsum(words * powers[:-1], dtype=np.uint64))
            )

    def at(self, places: np.ndarray, size: int) -> np.ndarray:
        value = (self.sums[places + size] - self.sums[places]) * self.back[places]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(29))


def word_hashes(memo: Memo, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and how many words each text has."""
    memo.trim()
    words = [text.split() for text in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    get = memo.__getitem__
    flat = np.fromiter((get(w) for run in words for w in run), np.uint64, int(sizes.sum()))
    return flat, sizes


def meeting_rows(
    hashes: np.ndarray, checks: np.ndarray | None, marks: np.ndarray, ids: pa.Array, owner: np.ndarray, places: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Rows that look for a partner, one per hash, and runs of places known as repeated.

    With checks there is a column ``extra``: the check of a row that looks for a partner, the
    length of a known run. Without, runs have one place.
    """
    if not len(hashes):
        return
    order = np.argsort(hashes, kind="stable") if checks is None else np.lexsort((checks, hashes))
    new = np.ones(len(order), bool)
    new[1:] = np.diff(hashes[order]) != 0
    if checks is not None:
        new[1:] |= np.diff(checks[order]) != 0
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(order)))
    first = np.sort(np.minimum.reduceat(order, heads))
    twice = np.sort(order[np.repeat(counts > 1, counts)])
    # neighbouring places of one text form a run
    start = np.ones(len(twice), bool)
    if checks is not None:
        start[1:] = (np.diff(twice) != 1) | (np.diff(owner[twice]) != 0) | (np.diff(places[twice]) != 1)
    heads = np.flatnonzero(start)
    runs = np.diff(np.append(heads, len(twice))).astype(np.int32)
    known = twice[heads]
    at = marks[owner] | places.astype(np.uint64)
    spread = (marks[owner[known]] + owner[known].astype(np.uint64)) * np.uint64(MULTIPLIERS[0])
    for picked, key, extra, sign in (
        (first, hashes[first], None if checks is None else checks[first], 0),
        (known, spread, runs, KNOWN),
    ):
        columns = [signed(key), ids.take(pa.array(owner[picked])), signed(at[picked] | np.uint64(sign))]
        names = ["hash", "name", "mark"]
        if checks is not None:
            columns.insert(1, pa.array(extra))
            names.insert(1, "extra")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def text_marks(texts: list[bytes]) -> np.ndarray:
    whole = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in texts), np.uint64, len(texts))
    return whole & np.uint64(TEXT_BITS)


def word_memo() -> Memo:
    return Memo(lambda word: xxhash.xxh3_64_intdigest(word))


def _anchors(window: int):
    period, residues = cover(window)
    size = window - period + 1

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo()
        wanted = np.zeros(period, bool)
        wanted[list(residues)] = True
        for batch in batches:
            names = batch.column("name")
            for at, texts in chunks(byte_texts(batch)):
                words, sizes = word_hashes(memo, texts)
                inside = positions_within(sizes)
                owner = np.repeat(np.arange(len(texts)), sizes)
                fits = (sizes[owner] >= window) & (inside + size <= sizes[owner]) & wanted[inside % period]
                picked = np.flatnonzero(fits)
                with np.errstate(over="ignore"):
                    hashes = Rolling(MULTIPLIERS[0], words).at(picked, size)
                    yield from meeting_rows(
                        hashes, None, text_marks(texts), names.slice(at, len(texts)), owner[picked], inside[picked]
                    )

    return emit


def _windows(window: int):
    period, _ = cover(window)
    size = window - period + 1

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo()
        for batch in batches:
            keys, ids = np.asarray(batch.column("text_mark")).view(np.uint64), batch.column("name")
            for at, texts in chunks(unpacked(batch)):
                words, sizes = word_hashes(memo, texts)
                starts = run_starts(sizes)
                owner = np.repeat(np.arange(len(texts)), sizes)
                # windows that hold an anchor: up to ``window - size`` words before it
                edges = np.zeros(len(words) + 1, np.int32)
                lists = batch.column("found").slice(at, len(texts))
                of = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(lists)))
                flat, runs = place_runs(np.asarray(lists.flatten()))
                np.add.at(edges, starts[of] + np.maximum(flat - (window - size), 0), 1)
                np.add.at(edges, starts[of] + flat + runs, -1)
                inside = positions_within(sizes)
                fits = (np.cumsum(edges[:-1]) > 0) & (inside + window <= sizes[owner])
                picked = np.flatnonzero(fits)
                with np.errstate(over="ignore"):
                    checks = Rolling(MULTIPLIERS[1], words).at(picked, window) >> np.uint64(32)
                    yield from meeting_rows(
                        Rolling(MULTIPLIERS[0], words).at(picked, window),
                        checks.astype(np.uint32).view(np.int32),
                        keys[at : at + len(texts)] << np.uint64(PLACE_BITS),
                        ids.slice(at, len(texts)), owner[picked], inside[picked],
                    )

    return emit


def place_runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return places >> RUN_BITS, places & ((1 << RUN_BITS) - 1)


def partners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hash, extra): known runs pass, others if their hash and check come again.

    The last row of a batch waits for the first of the next.
    """
    held: pa.RecordBatch | None = None  # one row whose equals may go on
    paired = False  # that row has a partner before it
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        known = np.asarray(batch.column("mark")) < 0
        equal = np.zeros(batch.num_rows + 1, bool)
        equal[1:-1] = ~known[1:] & ~known[:-1]
        for name in {"hash", "extra"} & set(batch.schema.names):
            equal[1:-1] &= np.diff(np.asarray(batch.column(name))) == 0
        keep = known | equal[:-1] | equal[1:]
        keep[0] |= paired
        paired = bool(keep[-1])
        held = batch.slice(batch.num_rows - 1)
        keep[-1] = False
        yield found_rows(batch, keep)
    if held is not None and paired:
        yield found_rows(held, np.ones(1, bool))


def found_rows(batch: pa.RecordBatch, keep: np.ndarray) -> pa.RecordBatch:
    """Text and place of the rows kept; a row that found its partner is a run of one."""
    marks = np.asarray(batch.column("mark"))[keep]
    runs = np.ones(len(marks), np.int64)
    if "extra" in batch.schema.names:
        runs = np.where(marks < 0, np.asarray(batch.column("extra"))[keep], 1).astype(np.int64)
    text_mark = (marks & ((1 << 63) - 1)) >> PLACE_BITS
    return pa.RecordBatch.from_arrays(
        [
            batch.column("name").filter(pa.array(keep)),
            pa.array(text_mark),
            pa.array((marks & PLACE) << RUN_BITS | runs),
        ],
        names=["name", "text_mark", "places"],
    )


def repeated(rows: DataFrame) -> DataFrame:
    """Per text the places found twice, as one array of distinct runs, however many rows hold the text."""
    order = [name for name in ("hash", "extra") if name in rows.columns]
    met = rows.repartition("hash").sortWithinPartitions(*order).mapInArrow(partners, FOUND)
    return met.groupBy("name", "text_mark").agg(F.collect_set("places").alias("found"))


PACKED = T.StructType(
    [
        T.StructField("name", T.LongType(), False),
        T.StructField("doc_id", T.LongType(), True),
        T.StructField("text_mark", T.LongType(), False),
        T.StructField("body", T.BinaryType(), False),
    ]
)


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as they cross the shuffle."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [text or b"" for text in byte_texts(batch)]
        names, ids = batch.column("name"), batch.column("doc_id")
        marks = (text_marks(texts) >> np.uint64(PLACE_BITS)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [names, ids, pa.array(marks), pa.array([squeeze(t) for t in texts], pa.binary())],
            names=["name", "doc_id", "text_mark", "body"],
        )


def unpacked(batch: pa.RecordBatch) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(body) for body in batch.column("body").to_pylist()]


def _kept(window: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, left = [], [], []
            for text, found in zip(unpacked(batch), batch.column("found").to_pylist(), strict=True):
                words = text.split()
                total.append(len(words))
                if found:
                    edges = np.zeros(len(words) + 1, np.int32)
                    starts, runs = place_runs(np.array(found))
                    ends = starts + runs - 1 + window
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, ends, -1)
                    stays = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
                    words = [words[i] for i in stays]
                removed.append(total[-1] - len(words))
                left.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
                    pa.array(left, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return emit


def joined(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    return texts.join(found, ["name", "text_mark"], how).select("name", "doc_id", "text_mark", "body", "found")


def drop_repeated(docs: DataFrame, window: int = 35) -> DataFrame:
    """Words left per document once every repeated window is taken out.

    ``docs``: doc_id, text; other columns are not read. A word is removed when a window of
    ``window`` words around it starts anywhere else, in the same text included; windows are
    judged on the input. Returns doc_id, n_words, n_removed, kept_sha256 and kept (the words
    left, joined by one space). A null or empty text has no words; texts shorter than the
    window keep all; repeated rows are places like any other, so rows that share id and text
    lose their windows. An empty table gives an empty result.
    """
    if window < 1:
        raise ValueError("window must be positive")
    doc_id = F.col("doc_id").cast("long")
    name = F.xxhash64(doc_id, doc_id.isNull(), F.col("text")).alias("name")
    docs = docs.select(name, doc_id.alias("doc_id"), "text")
    anchors = repeated(docs.mapInArrow(_anchors(window), ANCHORS))
    # not null, so that both joins read one and the same exchange of the texts
    texts = docs.mapInArrow(_packed, PACKED)
    windows = joined(texts, anchors, "inner").mapInArrow(_windows(window), WINDOWS)
    return joined(texts, repeated(windows), "left").mapInArrow(
        _kept(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
