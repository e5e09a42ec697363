"""Toxic documents by a bidirectional gated recurrent network with attention pooling.

A word enters with two inputs: its own vector, if the vocabulary knows it, and the vectors
of its character 3-, 4- and 5-grams. Column 0 of both tables is the log-odds of the word or n-gram
between toxic and other documents; the rest starts small and is trained. In training a document
is not counted among the documents of its own log-odds, words lose their vectors at random and
vectors decay, so that what stands in a few documents by chance is not learnt. The network reads windows of words forwards and backwards, weighs its states by attention and gives one
logit; a document's logit is the largest of all its windows, which overlap by half. Toxic
documents are toxic somewhere, so training takes from them the window that scores highest so far.

All labelled documents are trained on: words and n-grams are counted in all of them, then tasks
train on shards of them and the networks' mean starts the next round. The driver gets the vocabulary,
sums and means, never rows. Everything else is numpy in tasks over batches of texts, where only
distinct words pass through the input layer.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracebook.llm.common import byte_texts, chunks, run_starts, stored

WINDOW, STRIDE = 32, 16
HIDDEN, WIDTH = 6, 4
NGRAM_ROWS = 1 << 16
MIN_DOCS = 3
DROPPED, DECAY = 0.5, 2.0
WINDOWS_AT_ONCE = 4096
VOCABULARY = 1 << 17
WORDS_COUNTED_AT_ONCE = 200_000
RARER = 1000
SLICE = 1 << 14
BARE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def bare_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of other characters, A-Z lower-cased."""
    return text.translate(BARE).split()


def ngrams(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, row) of all character n-grams, a space at both ends of a word counted in; per size."""
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    spaces = np.cumsum(joined == 32)
    for size in (3, 4, 5):
        last = len(joined) - size + 1
        if last <= 0:
            continue
        hashed = np.full(last, size, np.uint32)
        for k in range(size):
            hashed = (hashed ^ joined[k : k + last]) * np.uint32(0x01000193)
            hashed ^= hashed >> np.uint32(15)
        inner = spaces[size - 2 : size - 2 + last] - spaces[:last]  # spaces between first and last byte
        at = np.flatnonzero(inner == 0)
        yield spaces[at] - 1, (hashed[at] & np.uint32(NGRAM_ROWS - 1)).astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def log_odds(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    return np.clip(odds, -3, 5).astype(np.float32)


class Network:
    """Inputs, two gated recurrences, attention and one output; parameters by name."""

    def __init__(self, vocabulary: dict[bytes, int], seed: int = 11):
        rng = np.random.default_rng(seed)
        inputs = 2 * WIDTH + 1
        self.vocabulary = vocabulary  # word -> row of "words"; row 0 is for unknown words

        def noise(*shape: int, scale: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "words": noise(len(vocabulary) + 1, WIDTH, scale=0.05),
            "grams": noise(NGRAM_ROWS, WIDTH, scale=0.05),
            "attend": noise(2 * HIDDEN),
            "out": noise(2 * HIDDEN, scale=0.5),
            "bias": np.zeros(1, np.float32),
        }
        for way in ("fw", "bw"):
            self.p[f"in_{way}"] = noise(inputs, 3 * HIDDEN)
            self.p[f"gate_{way}"] = noise(HIDDEN, 2 * HIDDEN)
            self.p[f"new_{way}"] = noise(HIDDEN, HIDDEN)
            self.p[f"b_{way}"] = np.zeros(3 * HIDDEN, np.float32)

    def inputs(
        self, words: list[bytes], odds: tuple[np.ndarray, np.ndarray] | None = None, kept: np.ndarray | None = None
    ) -> tuple[np.ndarray, tuple]:
        """One row per word: its vector, the mean of its n-grams, the strongest n-gram.

        ``odds`` (words, n-grams) stands for the two columns 0; words not ``kept`` have no vector.
        """
        known = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        own = self.p["words"][known]
        grams = self.p["grams"]
        if odds is not None:
            own[:, 0] = odds[0][known]
        if kept is not None:
            own[~kept, 1:] = 0
        total = np.zeros((len(words), WIDTH), np.float32)
        count = np.zeros(len(words), np.float32)
        best = np.full(len(words), -9, np.float32)
        traced = []
        for owner, row in ngrams(words):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
            if not len(heads):
                continue
            who = owner[heads]
            count[who] += np.diff(np.append(heads, len(owner)))
            vectors = grams[row]
            if odds is not None:
                vectors[:, 0] = odds[1][row]
            total[who] += np.add.reduceat(vectors, heads, axis=0)
            top = np.maximum.reduceat(vectors[:, 0], heads)
            better = top > best[who]
            traced.append((owner, row))
            best[who[better]] = top[better]
        count = np.maximum(count, 1)
        x = np.concatenate((own, total / count[:, None], best[:, None]), axis=1)
        return x, (known if kept is None else np.where(kept, known, 0), traced, count)

    def projected(self, x: np.ndarray) -> list[np.ndarray]:
        """What ``run`` reads of the words, forwards and backwards: to be made once for many windows."""
        # the last row is for places behind the end: its gate keeps the state as it is
        last = np.full((1, 3 * HIDDEN), 40, np.float32)
        return [np.concatenate((x @ self.p[f"in_{way}"] + self.p[f"b_{way}"], last)) for way in ("fw", "bw")]

    def run(
        self, x: np.ndarray, ids: np.ndarray, keep: bool = False, made: list[np.ndarray] | None = None
    ) -> tuple[np.ndarray, dict | None]:
        """Logits of windows: rows of word numbers into ``x``, -1 behind the end. made: ``projected`` of x."""
        made = made or self.projected(x)
        n, steps = ids.shape
        real = ids >= 0
        states = np.zeros((n, steps, 2 * HIDDEN), np.float32)
        memory: dict = {"real": real, "states": states}
        for side, way in enumerate(("fw", "bw")):
            h = np.zeros((n, HIDDEN), np.float32)
            trace = []
            for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                p = made[side].take(ids[:, t], axis=0, mode="wrap")
                gates = 1 / (1 + np.exp(-(p[:, : 2 * HIDDEN] + h @ self.p[f"gate_{way}"])))
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = 2 / (1 + np.exp(-2 * (p[:, 2 * HIDDEN :] + (r * h) @ self.p[f"new_{way}"]))) - 1
                if keep:
                    trace.append((t, h, z, r, new))
                h = new + z * (h - new)
                states[:, t, side * HIDDEN : (side + 1) * HIDDEN] = h
            memory[way] = trace
        weights = states @ self.p["attend"]
        weights = np.where(real, np.exp(np.clip(weights, -30, 30)), 1e-20)
        weights /= weights.sum(axis=1, keepdims=True)
        pooled = (weights[:, None, :] @ states)[:, 0]
        logits = pooled @ self.p["out"] + self.p["bias"][0]
        if not keep:
            return logits, None
        return logits, memory | {"weights": weights, "pooled": pooled, "ids": ids, "x": x}

    def gradients(self, memory: dict, slope: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the parameters and of the inputs, for the slope of the loss by each logit."""
        g = {name: np.zeros_like(value) for name, value in self.p.items() if name not in ("words", "grams")}
        states, weights, pooled, ids, x = (memory[k] for k in ("states", "weights", "pooled", "ids", "x"))
        g["out"], g["bias"] = pooled.T @ slope, slope.sum(keepdims=True)
        by_pooled = slope[:, None] * self.p["out"]
        by_states = weights[:, :, None] * by_pooled[:, None, :]
        by_weight = np.einsum("nh,nth->nt", by_pooled, states)
        by_score = weights * (by_weight - (weights * by_weight).sum(axis=1, keepdims=True))
        by_score = np.where(memory["real"], by_score, 0)
        g["attend"] = np.einsum("nt,nth->h", by_score, states)
        by_states += by_score[:, :, None] * self.p["attend"]
        by_x = np.zeros_like(x)
        for side, way in enumerate(("fw", "bw")):
            gate, new_w = self.p[f"gate_{way}"], self.p[f"new_{way}"]
            by_h = np.zeros((len(ids), HIDDEN), np.float32)
            by_projected = np.zeros((len(x), 3 * HIDDEN), np.float32)
            for t, h, z, r, new in reversed(memory[way]):
                by_h = by_h + by_states[:, t, side * HIDDEN : (side + 1) * HIDDEN]
                live = np.where(memory["real"][:, t, None], by_h, 0)
                d_new = live * (1 - z) * (1 - new * new)
                d_z = live * (h - new) * z * (1 - z)
                d_rh = d_new @ new_w.T
                d_r = d_rh * h * r * (1 - r)
                d_gates = np.concatenate((d_z, d_r), axis=1)
                g[f"gate_{way}"] += h.T @ d_gates
                g[f"new_{way}"] += (r * h).T @ d_new
                d_all = np.concatenate((d_gates, d_new), axis=1)
                np.add.at(by_projected, ids[:, t], d_all)  # rows behind the end are zero
                by_h = by_h - live + live * z + d_rh * r + d_gates @ gate.T
            g[f"b_{way}"] = by_projected.sum(axis=0)
            g[f"in_{way}"] = x.T @ by_projected
            by_x += by_projected @ self.p[f"in_{way}"].T
        return g, by_x

    def input_gradients(self, trace: tuple, by_x: np.ndarray, g: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
        """Of the two tables; added to ``g`` if given."""
        known, traced, count = trace
        g = g or {name: np.zeros_like(self.p[name]) for name in ("words", "grams")}
        np.add.at(g["words"], known, by_x[:, :WIDTH])
        g["words"][0] = 0  # unknown words stay where they are
        share = by_x[:, WIDTH : 2 * WIDTH] / count[:, None]
        for owner, row in traced:
            np.add.at(g["grams"], row, share[owner])
        return g


def numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the words of all texts as numbers, and the words per text."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    get = numbers.__getitem__
    # text by text, so that the words of one at a time are in memory
    runs = [np.fromiter(map(get, bare_words(text)), np.int64) for text in texts]
    sizes = np.fromiter(map(len, runs), np.int64, len(runs))
    return list(numbers), np.concatenate([np.zeros(0, np.int64), *runs]), sizes


def windows(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, word numbers) of all windows: every ``STRIDE`` words until the end is covered."""
    count = np.where(sizes > 0, 1 + np.maximum(-(-(sizes - WINDOW) // STRIDE), 0), 0)
    owner = np.repeat(np.arange(len(sizes)), count)
    inside = (np.arange(len(owner)) - np.repeat(run_starts(count), count)) * STRIDE
    at = inside[:, None] + np.arange(WINDOW)
    real = at < sizes[owner][:, None]
    ids = np.where(real, flat[np.minimum(run_starts(sizes)[owner][:, None] + at, max(len(flat) - 1, 0))], -1)
    return owner, ids


def logits(network: Network, texts: list[bytes]) -> np.ndarray:
    """The largest window logit of each text; texts without words get minus 30."""
    words, flat, sizes = numbered(texts)
    best = np.full(len(texts), -30, np.float32)
    if not len(flat):
        return best
    x, _ = network.inputs(words)
    owner, ids = windows(flat, sizes)
    made = network.projected(x)
    for at in range(0, len(owner), WINDOWS_AT_ONCE):
        part = slice(at, at + WINDOWS_AT_ONCE)
        found, _ = network.run(x, ids[part], made=made)
        np.maximum.at(best, owner[part], found)
    return best


@dataclass
class Evidence:
    """How many documents there are and hold each word and n-gram: of others in row 0, toxic ones in row 1."""

    documents: np.ndarray
    words: np.ndarray
    grams: np.ndarray

    def columns(self, label: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of words and n-grams; for a document of that label that is itself counted, without it."""
        less = np.array([label == 0, label == 1], float)
        n = self.documents - less
        found = []
        for counts in (self.words, self.grams):
            left = np.maximum(counts - less[:, None], 0)
            odds = log_odds(left[1], left[0], n[1], n[0])
            found.append(np.where(counts.sum(axis=0) >= MIN_DOCS, odds, 0).astype(np.float32))
        found[0][0] = 0
        return found[0], found[1]


def _counted(words: list[Counter[bytes]], grams: np.ndarray) -> pa.RecordBatch:
    names, rows = list(words[0] | words[1]), np.flatnonzero(grams.any(axis=0))
    columns = [pa.array(names + [None] * len(rows), pa.binary()), pa.array([None] * len(names) + rows.tolist(), pa.int32())]
    for held, found in zip(words, grams, strict=True):
        columns.append(pa.array([held[w] for w in names] + found[rows].tolist(), pa.int64()))
    return pa.RecordBatch.from_arrays(columns, names=["word", "gram", "other", "toxic"])


COUNTS = "word binary, gram int, other long, toxic long"


def _presence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, compressed, that hold each word and n-gram, by label; the empty word counts those with any word."""
    words, grams = [Counter(), Counter()], np.zeros((2, NGRAM_ROWS), np.int64)
    seen, expand = np.zeros(NGRAM_ROWS, bool), zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for text, label in zip(byte_texts(batch), batch.column("label").to_pylist(), strict=True):
            held = set(bare_words(expand(text)))
            if not held:
                continue
            seen[:] = False
            for _, row in ngrams(list(held)):
                seen[row] = True
            grams[label] += seen
            words[label].update(held)
            words[label][b""] += 1
            if len(words[0]) + len(words[1]) > WORDS_COUNTED_AT_ONCE:
                yield _counted(words, grams)
                words, grams = [Counter(), Counter()], np.zeros((2, NGRAM_ROWS), np.int64)
    yield _counted(words, grams)


def untrained(words: pa.Table, grams: pa.Table) -> tuple[Network, Evidence]:
    """A network that knows these words, its columns 0 filled, from the sums of ``_presence``."""
    held = {w: n for w, *n in zip(*(words.column(c).to_pylist() for c in ("word", "other", "toxic")), strict=True)}
    documents = np.array(held.pop(b"", [0, 0]), float)
    vocabulary = {w: at for at, w in enumerate(sorted(held), 1)}
    network = Network(vocabulary)
    evidence = Evidence(documents, np.zeros((2, len(vocabulary) + 1)), np.zeros((2, NGRAM_ROWS)))
    evidence.words[:, 1:] = np.array([held[w] for w in vocabulary], float).reshape(-1, 2).T
    for side, name in enumerate(("other", "toxic")):
        evidence.grams[side, np.asarray(grams.column("gram"))] = np.asarray(grams.column(name))
    network.p["words"][:, 0], network.p["grams"][:, 0] = evidence.columns()
    if not documents.all():  # without both labels its scores are all alike
        network.p["out"][:] = 0
        network.p["bias"][:] = 3 if documents[1] else -3
    return network, evidence


def turns(rng: np.random.Generator, rows: np.ndarray) -> Iterator[int]:
    """The rows in random order, again and again: each once before any twice."""
    while True:
        yield from rng.permutation(rows)


def improve(network: Network, evidence: Evidence, texts: tuple[list[bytes], np.ndarray, np.ndarray], toxic: np.ndarray,
            part: range, steps: int, rate: float, seed: tuple[int, ...]) -> bool:
    """Take these of all ``steps`` on the ``numbered`` texts; False if there is nothing to learn from.

    A step takes as many windows of toxic documents as of others. Of a toxic document it is the
    window with the highest logit when the steps begin, before the first one that with the
    strongest words and n-grams; of others any window or the highest.
    """
    words, flat, sizes = texts
    if not (sizes[toxic] > 0).any() or not (sizes[~toxic] > 0).any():
        return False
    without = [evidence.columns(label) for label in (0, 1)]
    owner, ids = windows(flat.astype(np.int32, copy=False), sizes)
    rng = np.random.default_rng(seed)
    moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in network.p.items()}
    score = np.zeros(len(ids), np.float32)
    sides = [np.flatnonzero(~toxic[owner]), np.flatnonzero(toxic[owner])]
    for side, rows in enumerate(sides):
        x = network.inputs(words, without[side])[0]
        strong, made = x[:, 0] + x[:, 2 * WIDTH], network.projected(x)
        for at in range(0, len(rows), WINDOWS_AT_ONCE):
            some = rows[at : at + WINDOWS_AT_ONCE]
            if part.start:
                score[some] = network.run(x, ids[some], made=made)[0]
            else:
                score[some] = np.sort(np.where(ids[some] >= 0, strong[ids[some]], -9), axis=1)[:, -2:].sum(axis=1)

    def highest(rows: np.ndarray) -> np.ndarray:
        """Of these windows the one with the largest score of each text."""
        order = rows[np.lexsort((score[rows], owner[rows]))]
        return order[np.append(owner[order][1:] != owner[order][:-1], True)]

    tables = {name: np.empty_like(network.p[name]) for name in ("words", "grams")}
    room = {name: np.empty_like(v) for name, v in network.p.items()}
    drawn = [(turns(rng, rows), n) for rows, n in ((highest(sides[1]), 64), (highest(sides[0]), 32), (sides[0], 32))]
    for step in part:
        rows = np.concatenate([np.fromiter(islice(source, n), np.int64, n) for source, n in drawn])
        inputs, local, traces, before = [], [], [], 0
        for side, some in ((1, rows[:64]), (0, rows[64:])):
            used, numbers = np.unique(ids[some], return_inverse=True)
            numbers = numbers.reshape(len(some), WINDOW)
            if used[0] < 0:
                used, numbers = used[1:], numbers - 1
            x, trace = network.inputs([words[w] for w in used], without[side], rng.random(len(used)) >= DROPPED)
            local.append(np.where(numbers >= 0, numbers + before, -1))
            inputs.append(x)
            traces.append(trace)
            before += len(x)
        found, memory = network.run(np.concatenate(inputs), np.concatenate(local), keep=True)
        slope = (sigmoid(found) - toxic[owner[rows]]).astype(np.float32) / len(rows)
        g, by_x = network.gradients(memory, slope)
        for value in tables.values():
            value.fill(0)
        for trace, some in zip(traces, np.split(by_x, [len(inputs[0])]), strict=True):
            network.input_gradients(trace, some, tables)
        speed, taken = rate * (1 - (step + 1) / (steps + 1)), step - part.start + 1
        for name, value in (g | tables).items():
            if name in ("words", "grams"):
                value[:, 0] = 0  # the log-odds stay as they are counted
                network.p[name][:, 1:] *= 1 - speed * DECAY
            (m, v), change = moments[name], room[name]
            m *= 0.9
            m += np.multiply(value, 0.1, out=change)
            v *= 0.99
            v += np.multiply(np.square(value, out=change), 0.01, out=change)
            np.sqrt(np.divide(v, 1 - 0.99**taken, out=change), out=change)
            change += 1e-6
            np.divide(m, change, out=change)
            change *= speed / (1 - 0.9**taken)
            network.p[name] -= change
    return True


def rounds(steps: int) -> list[range]:
    """The steps between which windows are chosen anew."""
    marks = [0, steps // 4, steps // 2, steps]
    return [range(*part) for part in zip(marks, marks[1:], strict=False) if part[0] < part[1]]


def train(sample: list[tuple[str, int]], steps: int = 400, rate: float = 0.02, seed: int = 5) -> Network:
    """Fit the network to (text, label) rows at hand, as ``fitted`` does to a table in one shard."""
    texts, toxic = [(text or "").encode() for text, _ in sample], np.array([label == 1 for _, label in sample], bool)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(toxic.astype(np.int32))], names=["text", "label"])
    found = pa.Table.from_batches(_presence(_squeezed([batch]))).group_by(["word", "gram"]).aggregate([("other", "sum"), ("toxic", "sum")])
    found = found.rename_columns(["word", "gram", "other", "toxic"])
    often = pc.greater_equal(pc.add(found["other"], found["toxic"]), MIN_DOCS)
    words = pc.and_(pc.is_valid(found["word"]), pc.or_(often, pc.equal(found["word"], pa.scalar(b"", pa.binary()))))
    network, evidence = untrained(found.filter(words), found.filter(pc.is_valid(found["gram"])))
    numbers = numbered(texts)
    for part in rounds(steps) if evidence.documents.all() else ():
        improve(network, evidence, numbers, toxic, part, steps, rate, (seed, 0, part.start))
    return network


def _squeezed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array([squeeze(text) for text in byte_texts(batch)], pa.binary()))


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """(key, label, text) of all documents with that label 0 or 1, texts compressed; equal rows count once.

    ``usable`` is a condition on doc_id, so that the rows of others need not be joined.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull() & usable)
    small = texts.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    small = small.mapInArrow(_squeezed, "doc_id long, hash long, text binary")
    # labels grow with the documents
    found = small.join(known.hint("merge"), "doc_id")
    rows = found.groupBy("doc_id", "hash", "label").agg(F.min("text").alias("text"))
    return rows.select(F.xxhash64("doc_id", "hash", "label").alias("key"), "label", "text")


def counted(rows: DataFrame, most: int = VOCABULARY) -> tuple[Network, Evidence]:
    """``untrained`` from all labelled rows: its words are the ``most`` that stand in most documents.

    Words that equally many documents hold are all known or none; others enter by their n-grams.
    """
    sums = rows.select("text", "label").mapInArrow(_presence, COUNTS).groupBy("word", "gram")
    sums = sums.agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    sums = sums.withColumn("n", F.col("other") + F.col("toxic"))
    sums = sums.where((F.col("n") >= MIN_DOCS) | (F.length("word") == 0)).persist(StorageLevel.DISK_ONLY)
    words = sums.where(F.col("word").isNotNull())
    inside, least = 0, MIN_DOCS
    # one row per distinct count
    often = words.where(F.col("n") >= MIN_DOCS).groupBy("n").agg(F.count("*").alias("words")).collect()
    for n, many in sorted(((r.n, r.words) for r in often), reverse=True):
        inside += many
        if inside > most + 1:  # the empty word is none of them
            least = n + 1
            break
    words = words.where((F.col("n") >= least) | (F.length("word") == 0)).toArrow()
    found = untrained(words, sums.where(F.col("gram").isNotNull()).toArrow())
    sums.unpersist()
    return found


def shards(rows: DataFrame, documents: np.ndarray, steps: int) -> DataFrame:
    """(shard, key, label, text): every row in a shard by its key, so that the same rows give the same shards.

    In the second half of the steps the highest windows of all documents of a shard have their turn.
    Of the rarer label a shard has up to ``RARER``; if there are too few of them for all, rows stand in several.
    """
    many = max(1, math.ceil(documents.max() / max(1, steps // 2 * 30)))
    groups = [many if n == documents.max() else min(many, math.ceil(n / RARER)) for n in documents]
    of_label = F.when(F.col("label") == 0, groups[0]).otherwise(groups[1])
    own = F.explode(F.sequence(F.pmod("key", of_label).cast("int"), F.lit(many - 1), of_label)).alias("shard")
    return rows.select(own, "key", "label", "text").repartition(many, "shard")


def _packed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """A shard as one row: its distinct words, the words of all texts as numbers, words per text, labels."""
    rows = rows.sort_by("key").combine_chunks()
    expand = zstandard.ZstdDecompressor().decompress
    words, flat, sizes = numbered([expand(text) for text in rows.column("text").to_pylist()])
    columns = [b" ".join(words), flat.astype(np.int32), sizes, np.asarray(rows.column("label"), np.int64)]
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())} | {
        name: pa.array([squeeze(c)], pa.binary()) for name, c in zip(PACKED, columns, strict=True)
    })


PACKED = ("words", "flat", "sizes", "labels")


def _improved(network: Network, evidence: Evidence, part: range, steps: int, rate: float, seed: int):
    def of_shard(shard: int, packed: list[bytes]) -> pa.RecordBatch:
        own = Network.__new__(Network)
        own.vocabulary, own.p = network.vocabulary, {name: v.copy() for name, v in network.p.items()}
        words, flat, sizes, labels = map(zstandard.ZstdDecompressor().decompress, packed)
        texts = words.split(), np.frombuffer(flat, np.int32), np.frombuffer(sizes, np.int64)
        toxic = np.frombuffer(labels, np.int64) == 1
        learnt = improve(own, evidence, texts, toxic, part, steps, rate, (seed, shard, part.start))
        whole = np.concatenate([own.p[name].ravel() for name in sorted(own.p)]) if learnt else np.zeros(0, np.float32)
        slices = [whole[at : at + SLICE].tobytes() for at in range(0, len(whole), SLICE)]
        columns = [pa.array([shard] * len(slices), pa.int32()), pa.array(range(len(slices)), pa.int32()), pa.array(slices, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "slice", "numbers"])

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                yield of_shard(row.column("shard")[0].as_py(), [row.column(name)[0].as_py() for name in PACKED])

    return emit


def _mean(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("shard")
    total = sum(np.frombuffer(v.as_buffer(), np.float32).astype(np.float64) for v in rows.column("numbers"))
    mean = (total / rows.num_rows).astype(np.float32)
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "numbers": pa.array([mean.tobytes()], pa.binary())})


def fitted(
    docs: DataFrame, labels: DataFrame, usable: Column, steps: int = 400, rate: float = 0.02, seed: int = 5
) -> Network:
    """A network trained on all labelled rows that are ``usable``.

    Words and n-grams are counted in all of them. In each round every shard takes its steps from the
    same network, and the mean of what the shards made of it is where the next round starts.
    """
    rows = stored(labelled(docs, labels, "toxic", usable))
    network, evidence = counted(rows)
    if not evidence.documents.all():
        return network
    packed = shards(rows, evidence.documents, steps).groupBy("shard").applyInArrow(
        _packed, "shard int, " + ", ".join(f"{name} binary" for name in PACKED)
    )
    packed = packed.persist(StorageLevel.DISK_ONLY)
    for part in rounds(steps):
        made = packed.mapInArrow(
            _improved(network, evidence, part, steps, rate, seed), "shard int, slice int, numbers binary"
        )
        found = made.groupBy("slice").applyInArrow(_mean, "slice int, numbers binary").toArrow().sort_by("slice")
        if not found.num_rows:  # no shard has both labels
            break
        flat = np.frombuffer(b"".join(found.column("numbers").to_pylist()), np.float32)
        ends = np.cumsum([network.p[name].size for name in sorted(network.p)])
        for name, values in zip(sorted(network.p), np.split(flat, ends[:-1]), strict=True):
            network.p[name] = values.reshape(network.p[name].shape).copy()
    packed.unpersist()
    return network


def _score(network: Network):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.float32)]
            found += [logits(network, texts) for _, texts in chunks(byte_texts(batch), 1 << 20)]
            score = sigmoid(np.concatenate(found).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    return emit


def scored(docs: DataFrame, network: Network, score: str = "score") -> DataFrame:
    """``docs``, all columns, and the toxicity of ``text`` from 0 to 1."""
    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    schema = T.StructType([*packed.schema.fields, T.StructField("score", T.DoubleType(), False)])
    return packed.mapInArrow(_score(network), schema).select("row.*", F.col("score").alias(score))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    ``labels``: doc_id, toxic; other columns of both are not read. Rows where ``held_out`` is true
    are never trained on. Every window of every whole text is scored. A null or empty text scores
    like one without any words, next to 0; repeated rows get a row each; without labels of both
    kinds all scores are alike; an empty table gives an empty result.
    """
    network = fitted(docs, labels, ~held_out)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scored(read, network).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
