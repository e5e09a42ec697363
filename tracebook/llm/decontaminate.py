"""Benchmark items inside documents, up to a share of word edits.

Every window of the size of an item is embedded as by CGK: a walk over its words that stays or
steps on by a random bit drawn for the step and the word. Two windows a few edits apart walk
together again soon after each edit, so edit distance becomes Hamming distance between the walks,
and sampled steps of a walk are a locality-sensitive hash. One repetition has its own bits and its
own sample; how many are taken follows from ``recall``: edited copies of the items are embedded
when the index is built, and repetitions are added until that share of them is found. A class of
items that stays under it (long items meet edits in every walk) is looked up by parts instead,
which misses nothing: of e + 1 parts of an item, e edits leave one as it is. A window that meets
an item is verified by the exact edit distance between the item and the text there.

Items are sorted into size classes a quarter apart; a class walks over as many words as its
smallest item has. A window within the allowed edits has almost all its words in common with an
item, so windows with too many words that no item of the class has are not embedded.

Items come in blocks of bounded size, whatever their number; each block is one pass over the
documents, which are neither shuffled nor gathered.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracebook.llm.common import byte_texts, chunks, positions_within, run_starts

ITEMS_PER_BLOCK = 20_000
SAMPLED_STEPS = 3
MOST_REPETITIONS = 64
TRIALS = 300
SKIP = -1
HIT = "doc_id long, item_id long, start long, edits long, similarity double"


def plain(word: bytes) -> str:
    """A word's letters and digits, lower-cased."""
    word = word.decode("utf-8", "replace").lower()
    return word if word.isalnum() else "".join(c for c in word if c.isalnum())


# ASCII: letters in lower case and digits stay, white space too, all else goes
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MARKS = bytes(b for b in range(33, 128) if not chr(b).isalnum())


class WordCodes(dict):
    """Codes of words whose ASCII part is plain already; others are made plain when first met."""

    def __init__(self, codes: dict[str, int], limit: int = 200_000):
        self.base = {word.encode(): code for word, code in codes.items()}
        super().__init__(self.base)
        self.codes, self.limit = codes, limit

    def __missing__(self, word: bytes) -> int:
        if word.isascii():
            bare = word.decode() if word.isalnum() else plain(word)
        else:
            bare = plain(word)
        value = self[word] = self.codes.get(bare, 0) if bare else SKIP
        return value

    def run(self, text: bytes) -> np.ndarray:
        """The codes of a text's words; words without letters or digits are left out."""
        found = np.fromiter(map(self.__getitem__, text.translate(LOWER, MARKS).split()), np.int32)
        return found[found != SKIP]

    def trim(self) -> None:
        if len(self) > self.limit + len(self.base):
            self.clear()
            self.update(self.base)


def plain_words(text: bytes) -> list[str]:
    return [p for p in map(plain, text.split()) if p]


def class_size(words: int) -> int:
    """The largest class at or below a size; sizes up to 12 are their own classes."""
    size = words if words < 12 else 12
    while size >= 12 and math.ceil(size * 1.25) <= words:
        size = math.ceil(size * 1.25)
    return size


@dataclass
class SizeClass:
    size: int
    edits: int  # most edits that an item of the class allows
    vocabulary: np.ndarray  # per word code: is it in an item of the class
    items: list[int]
    walks: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # (rule by step, sample)
    tables: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # sorted keys and their items
    # where walks find too few: by length of the parts, sorted keys, their items and where in them
    parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)


def hashed_codes(words: int) -> np.ndarray:
    """A well-mixed number per word code."""
    with np.errstate(over="ignore"):
        mixed = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def step_bits(hashed: np.ndarray, rule: np.ndarray, here: np.ndarray) -> np.ndarray:
    """Whether walks at these words go on: the top bit of a product drawn by ``rule``.

    A walk is two numbers a step, however many words there are. The bits of all words are made
    where more places ask for them than there are words.
    """
    if len(here) < len(hashed):
        return ((hashed.take(here) * rule[0] + rule[1]) >> np.uint64(63)).astype(np.int32)
    return ((hashed * rule[0] + rule[1]) >> np.uint64(63)).astype(np.int32).take(here)


def walk_keys(codes: np.ndarray, starts: np.ndarray, hashed: np.ndarray, rules: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """The sampled steps of the walks from ``starts`` over codes with hashes, as one number each."""
    codes, starts = codes.astype(np.int32, copy=False), starts.astype(np.int32)
    at = np.zeros(len(starts), np.int32)
    keys = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for step in range(int(sample.max()) + 1):
            here = codes.take(starts + at)  # a walk of so many steps stays in its window
            if step in sample:
                keys = (keys ^ here.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                keys ^= keys >> np.uint64(29)
            at += step_bits(hashed, rules[step], here)
    return keys


def run_keys(codes: np.ndarray, size: int) -> np.ndarray:
    """One number for each run of ``size`` codes."""
    count = max(len(codes) - size + 1, 0)
    keys = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for step in range(size):
            keys = (keys ^ codes[step : step + count].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
    return keys


def met(keys: np.ndarray, got: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of equal keys: (in ``got``, in the sorted ``keys``)."""
    low, high = np.searchsorted(keys, got, "left"), np.searchsorted(keys, got, "right")
    many = high - low
    return np.repeat(np.arange(len(got)), many), np.repeat(low, many) + positions_within(many)


def edited(rng: np.random.Generator, words: np.ndarray, edits: int, size: int) -> np.ndarray:
    """The words after random edits, padded with unknown words."""
    held = list(words)
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(max(len(held), 1)))
        if kind == 0 and held:
            held[at] = 0
        elif kind == 1:
            held.insert(at, 0)
        elif held:
            del held[at]
    return np.array((held + [0] * size)[:size], np.int64)


class ItemIndex:
    """A block of items under sampled walks, class by class."""

    def __init__(self, items: list[tuple[int, str]], share: float, recall: float, seed: int = 7):
        self.share = share
        words = [plain_words((text or "").encode()) for _, text in items]
        known = sorted({w for run in words for w in run})
        self.codes = {w: at for at, w in enumerate(known, 1)}  # 0: a word that no item has
        self.hashed = hashed_codes(len(known) + 1)
        self.ids = [item_id for item_id, _ in items]
        self.words = [np.array([self.codes[w] for w in run], np.int64) for run in words]
        rng = np.random.default_rng(seed)
        self.classes: list[SizeClass] = []
        by_size: dict[int, list[int]] = {}
        for at, run in enumerate(self.words):
            if len(run):
                by_size.setdefault(class_size(len(run)), []).append(at)
        for size, members in sorted(by_size.items()):
            self.classes.append(self.build(size, members, recall, rng))
        self.bags = [Counter(run.tolist()) for run in self.words]
        self.widest = max((c.size for c in self.classes), default=1)

    def allowed(self, item: int) -> int:
        return int(self.share * len(self.words[item]) + 1e-9)

    def build(self, size: int, members: list[int], recall: float, rng: np.random.Generator) -> SizeClass:
        vocabulary = np.zeros(len(self.codes) + 1, bool)
        for item in members:
            vocabulary[self.words[item]] = True
        made = SizeClass(size, max(map(self.allowed, members)), vocabulary, members)
        flat = np.concatenate([self.words[item][:size] for item in members])
        starts = np.arange(len(members)) * size
        picked = rng.integers(len(members), size=min(TRIALS, 50 * len(members)))
        trials = np.concatenate(
            [edited(rng, self.words[members[p]], self.allowed(members[p]), size) for p in picked]
        )
        found = np.zeros(len(picked), bool)
        while len(made.walks) < MOST_REPETITIONS and found.mean() < recall:
            # steps of the first half of the walk: it has met fewer edits there
            rules = rng.integers(1 << 64, size=(size, 2), dtype=np.uint64) | np.array([1, 0], np.uint64)
            sample = np.sort(rng.choice(size, min(SAMPLED_STEPS, size), replace=False))
            keys = walk_keys(flat, starts, self.hashed, rules, sample)
            order = np.argsort(keys, kind="stable")
            made.walks.append((rules, sample))
            made.tables.append((keys[order], np.array(members)[order]))
            found |= walk_keys(trials, np.arange(len(picked)) * size, self.hashed, rules, sample) == keys[picked]
        if found.mean() < recall:
            made.walks, made.tables, made.parts = [], [], self.cut(members)
        return made

    def cut(self, members: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Every item in one part more than it allows edits, looked up by the first words of each part."""
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for item in members:
            words = self.words[item]
            count = min(self.allowed(item) + 1, len(words))
            size = len(words) // count
            keys = run_keys(words, size)
            places = np.arange(count) * len(words) // count
            rows.setdefault(size, []).extend((int(keys[p]), item, int(p)) for p in places)
        return {
            size: (
                np.array([k for k, _, _ in found], np.uint64),
                np.array([i for _, i, _ in found], np.int64),
                np.array([p for _, _, p in found], np.int64),
            )
            for size, found in ((size, sorted(found)) for size, found in rows.items())
        }

    def candidates(
        self, codes: np.ndarray, left: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | int]]:
        """(place, item, place in the item) where text and item meet. left: words to the end of the own text."""
        for made in self.classes:
            for size, (keys, items, places) in made.parts.items():
                at, part = met(keys, run_keys(codes, size))
                own = left[at] >= size
                yield at[own], items[part[own]], places[part[own]]
            if not made.walks:
                continue
            inside = np.concatenate(([0], np.cumsum(made.vocabulary[codes])))
            last = np.minimum(np.arange(len(codes)) + made.size, len(codes))
            last = np.minimum(last, np.arange(len(codes)) + left)
            starts = np.flatnonzero(inside[last] - inside[:-1] >= max(made.size - made.edits, 1))
            if not len(starts):
                continue
            for (rules, sample), (keys, items) in zip(made.walks, made.tables, strict=True):
                got = walk_keys(codes, starts, self.hashed, rules, sample)
                at, entry = met(keys, got)
                yield starts[at], items[entry], 0


def edits_within(item: np.ndarray, text: np.ndarray) -> int:
    """Fewest word edits that turn the item into some run of words of the text."""
    row = np.zeros(len(text) + 1, np.int64)
    steps = np.arange(len(text) + 1)
    for at, word in enumerate(item, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        best = np.concatenate(([at], best))
        # an insertion costs one per word: the running minimum of what is left of it
        row = np.minimum.accumulate(best - steps) + steps
    return int(row.min())


def _scan(index: ItemIndex, emit_rows):
    """Runs ``emit_rows(batch, hits)`` per batch; hits: (row, item, start word, edits), one per row and item."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes(index.codes)
        pad = index.widest
        for batch in batches:
            hits: dict[tuple[int, int], tuple[int, int]] = {}
            for at, texts in chunks(byte_texts(batch), 2 << 20):
                codes.trim()
                runs = [codes.run(text) for text in texts]
                sizes = np.array([len(run) for run in runs])
                flat = np.concatenate([x for run in runs for x in (run, np.zeros(pad, np.int32))])
                starts = run_starts(sizes + pad)
                left = np.repeat(starts + sizes, sizes + pad) - np.arange(len(flat))
                tried: set[tuple[int, int, int]] = set()
                for where, items, skipped in index.candidates(flat, np.maximum(left, 0)):
                    owner = np.searchsorted(starts, where, side="right") - 1
                    pairs = np.unique(np.stack([owner, items, where - skipped - starts[owner]], axis=1), axis=0)
                    for row, item, place in pairs.tolist():
                        size, allowed = len(index.words[item]), index.allowed(item)
                        # windows a few words apart are verified by the same stretch of text
                        near = (row, item, place // (allowed + 1))
                        if near in tried or hits.get((at + row, item), (0, 1))[1] == 0:
                            continue
                        tried.add(near)
                        low = max(0, near[2] * (allowed + 1) - allowed)
                        run = runs[row][low : low + size + 4 * allowed + 1]
                        if (Counter(run.tolist()) & index.bags[item]).total() < size - allowed:
                            continue  # too few words in common for so few edits
                        edits = edits_within(index.words[item], run)
                        if edits <= allowed:
                            best = hits.get((at + row, item), (low, size + 1))
                            hits[at + row, item] = min(best, (low, edits), key=lambda x: (x[1], x[0]))
            yield emit_rows(batch, hits)

    return emit


def item_blocks(items: DataFrame, share: float, recall: float) -> Iterator[ItemIndex]:
    """Indexes over blocks of at most about ``ITEMS_PER_BLOCK`` items."""
    kept = items.select(F.col("item_id").cast("long"), "text").where("text is not null").distinct()
    blocks = max(1, -(-kept.count() // ITEMS_PER_BLOCK))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for at in range(blocks):
        rows = kept.where(block == at).orderBy("item_id", "text").collect()
        yield ItemIndex([(r.item_id, r.text) for r in rows], share, recall)


def _hit_rows(index: ItemIndex):
    def rows(batch: pa.RecordBatch, hits: dict) -> pa.RecordBatch:
        ids = batch.column("doc_id").to_pylist()
        found = [
            (ids[row], index.ids[item], start, edits, 1 - edits / len(index.words[item]))
            for (row, item), (start, edits) in sorted(hits.items())
        ]
        columns = list(zip(*found, strict=True)) or [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["doc_id", "item_id", "start", "edits", "similarity"],
        )

    return rows


def _without_hits(batch: pa.RecordBatch, hits: dict) -> pa.RecordBatch:
    stays = np.ones(batch.num_rows, bool)
    stays[[row for row, _ in hits]] = False
    return batch.filter(pa.array(stays))


def contained_items(docs: DataFrame, items: DataFrame, share: float = 0.2, recall: float = 0.99) -> DataFrame:
    """(doc_id, item_id, start, edits, similarity): items that stand in a document.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are not read. Words are
    compared by their letters and digits, lower-cased; words without any are left out. An item of
    n words stands in a text if it can be turned into a run of the text's words by at most
    ``share`` * n words inserted, deleted or replaced. One row per row of ``docs`` and item, with
    the fewest edits found and the word from which the text was compared. Null or empty texts and
    items hold nothing and stand nowhere; repeated rows give repeated hits; an empty table on
    either side gives an empty result.
    """
    read = docs.select(F.col("doc_id").cast("long"), "text")
    found = None
    for index in item_blocks(items, share, recall):
        part = read.mapInArrow(_scan(index, _hit_rows(index)), HIT)
        found = part if found is None else found.union(part)
    return found


def without_items(docs: DataFrame, items: DataFrame, share: float = 0.2, recall: float = 0.99) -> DataFrame:
    """``docs``, all columns, without the rows in whose text an item stands (see ``contained_items``)."""
    for index in item_blocks(items, share, recall):
        docs = docs.mapInArrow(_scan(index, _without_hits), docs.schema)
    return docs
