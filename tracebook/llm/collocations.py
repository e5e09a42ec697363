"""Phrases that occur more often than their parts suggest, from one count of the longest windows.

Every word opens one window: itself and the words behind it in its piece, up to the longest
phrase, padded where the piece ends. Only these longest windows are counted. A phrase of fewer
words is the beginning of windows, so its count is the sum over what may follow: a ROLLUP over the
window's columns adds up longest windows to shorter prefixes, down to all words of a language,
and no shorter n-grams are ever made from the texts.

Windows are counted per run of texts in the tasks, where words are numbers, and meet once, on
language and all words but the last. There, endings that no candidate can have (rarer than
``min_count``) are put together before the ROLLUP, which leaves it as many rows as there are
frequent phrases. Every prefix keeps its exact sum.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracebook.llm.common import byte_texts, stored

LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
PLAIN = bytes(10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b for b in LETTERS)
SLICE_BYTES = 1 << 20
BITS = 21
WORDS_AT_ONCE, DISTINCT_AT_ONCE = 3_000_000, 1 << 19
BUCKETS = 256
WINDOWS = "key string, n long"


class Numbers(dict):
    """Words numbered as they come; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def slices(text: bytes) -> Iterator[bytes]:
    """A text in parts of about a megabyte, cut at white space."""
    start = 0
    while len(text) - start > SLICE_BYTES:
        ends = [at for at in (text.find(b" ", start + SLICE_BYTES), text.find(b"\n", start + SLICE_BYTES)) if at >= 0]
        if not ends:
            break
        yield text[start : min(ends)]
        start = min(ends)
    yield text[start:]


def word_numbers(text: bytes, numbers: Numbers) -> list[np.ndarray]:
    """The words of a text as numbers, 0 between pieces and at the end."""
    found = []
    for part in slices(text.translate(PLAIN)):
        # no word is a full stop: it would have ended the piece
        words = part.replace(b"\n", b" . ").split()
        found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    return [*found, np.zeros(1, np.int64)]


def distinct_windows(flat: np.ndarray, words: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``words`` words, 0 behind the end of a piece, and how often each occurs."""
    size = len(flat)
    flat = np.concatenate((flat, np.zeros(words, np.int64)))
    inside = flat[:size] > 0
    opens, columns = inside, [flat[:size][inside]]
    for k in range(1, words):
        inside = inside & (flat[k : size + k] > 0)
        columns.append(np.where(inside, flat[k : size + k], 0)[opens])
    if vocabulary >= 1 << BITS:  # one text with millions of different words
        return np.unique(np.stack(columns, axis=1), axis=0, return_counts=True)
    packed = columns[0]
    for column in columns[1:]:
        packed = (packed << BITS) | column
    found, n = np.unique(packed, return_counts=True)
    shifts = BITS * np.arange(words - 1, -1, -1)
    return (found[:, None] >> shifts) & ((1 << BITS) - 1), n


class Run:
    """Texts of one language whose windows are counted together."""

    def __init__(self):
        self.numbers, self.words, self.size = Numbers({b".": 0}), [], 0

    def add(self, text: bytes) -> None:
        for found in word_numbers(text, self.numbers):
            self.words.append(found)
            self.size += len(found)

    def full(self) -> bool:
        return self.size >= WORDS_AT_ONCE or len(self.numbers) >= DISTINCT_AT_ONCE

    def counted(self, language: str, words: int) -> Iterator[pa.RecordBatch]:
        """(key, count) of distinct windows: the last word, the words before it, the language.

        They stand between tabs, which no word holds: one column is shuffled with less around it.
        """
        found, n = distinct_windows(np.concatenate(self.words), words, len(self.numbers))
        names = pa.array([b"", *list(self.numbers)[1:]], pa.binary())
        for at in range(0, len(n), 1 << 16):
            part = found[at : at + (1 << 16)]
            columns = [names.take(pa.array(part[:, k])).cast(pa.string()) for k in range(words)]
            first = columns[0] if words == 2 else pc.binary_join_element_wise(*columns[:-1], " ")
            key = pc.binary_join_element_wise(columns[-1], first, pa.scalar(language), "\t")
            count = pa.array(n[at : at + (1 << 16)].astype(np.int64))
            yield pa.RecordBatch.from_arrays([key, count], names=["key", "n"])


def _count(words: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, Run] = {}
        for batch in batches:
            names = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            for language, text in zip(names, byte_texts(batch), strict=True):
                if not text:
                    continue
                run = runs.setdefault(language, Run())
                run.add(text)
                if run.full():
                    yield from runs.pop(language).counted(language, words)
                # many languages share what one may hold
                while sum(run.size for run in runs.values()) >= WORDS_AT_ONCE:
                    language = max(runs, key=lambda name: runs[name].size)
                    yield from runs.pop(language).counted(language, words)
        for language in list(runs):
            yield from runs.pop(language).counted(language, words)

    return emit


def phrase_counts(docs: DataFrame, words: int = 3, min_count: int = 10) -> DataFrame:
    """(lang, phrase, words, n) of all phrases of up to ``words`` words found ``min_count`` times or more.

    ``phrase`` is joined by spaces; the row with no words has the number of all words of the language.
    """
    read = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    head = F.expr("substring(key, instr(key, '\t') + 1)")
    windows = read.mapInArrow(_count(words), WINDOWS).repartition(head)
    windows = windows.select(head.alias("head"), F.substring_index("key", "\t", 1).alias("last"), "n")
    longest = windows.groupBy("head", "last").agg(F.sum("n").alias("n"))
    # in place, as rows of one head lie together: endings that are too rare become no ending,
    ending = F.when(F.col("n") >= min_count, F.col("last")).otherwise("")
    endings = longest.groupBy("head", ending.alias("last")).agg(F.sum("n").alias("n"))
    # then beginnings that are too rare keep their first word alone
    of_head = F.sum("n").over(Window.partitionBy("head"))
    often = of_head >= min_count if words > 2 else F.lit(True)
    heads = F.split(F.substring_index("head", "\t", 1), " ")
    lang = F.expr("substring(head, instr(head, '\t') + 1)")
    names = [f"w{k}" for k in range(words)]
    columns = [F.get(heads, F.lit(k)) for k in range(words - 1)]
    columns = [columns[0], *[F.when(F.col("often"), column).otherwise("") for column in columns[1:]]]
    windows = (
        endings.withColumn("often", often)
        .select(
            lang.alias("lang"), *[column.alias(name) for column, name in zip(columns, names, strict=False)],
            F.when(F.col("often"), F.col("last")).otherwise("").alias(names[-1]), "n",
        )
        .groupBy("lang", *names)
        .agg(F.sum("n").alias("n"))
    )
    level = F.length(F.replace(F.bin(F.grouping_id()), F.lit("0"), F.lit("")))
    sums = windows.rollup("lang", *names).agg(F.sum("n").alias("n"), (words - level).cast("int").alias("words"))
    kept = [F.when(F.col("words") > k, F.col(name)) for k, name in enumerate(names)]
    return sums.where(
        (F.col("words") == 0)
        | ((F.col("words") > 0) & (F.col("n") >= min_count) & (F.get(F.array(*names), F.col("words") - 1) != ""))
    ).select("lang", F.array_join(F.array(*kept), " ").alias("phrase"), "words", "n")


def cuts(words: int) -> Column:
    """All ways to cut ``phrase`` in two: (k, head, rest)."""
    parts = F.split("phrase", " ")
    return F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice(parts, F.lit(1), k), " ").alias("head"),
            F.array_join(F.slice(parts, k + 1, F.lit(words)), " ").alias("rest"),
        ),
    )


def scored_phrases(counts: DataFrame, words: int) -> DataFrame:
    """Phrases of two words and more with their lowest-scoring cut: lang, phrase, words, a, l, r, score."""
    phrases = counts.where("words > 1").withColumnRenamed("n", "a")
    parts = phrases.select("lang", "phrase", "words", "a", F.inline(cuts(words)))
    first = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    second = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    wide = {name: F.col(name).cast("decimal(19,0)") for name in ("a", "l", "r")}
    both = parts.join(first, ["lang", "head"]).join(second, ["lang", "rest"])
    both = both.withColumn("above", F.lit(1_000_000).cast("decimal(7,0)") * wide["a"] * wide["a"])
    both = both.withColumn("below", wide["l"] * wide["r"]).withColumn("score", F.expr("above div below"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "words", "a").agg(lowest).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"
    )


def without_parts(phrases: DataFrame, words: int, share_percent: int) -> DataFrame:
    """Phrases that no longer phrase holds with ``share_percent`` of their count or more."""
    parts = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice(parts, at, size), " ")
            ),
        )
    )
    longer = phrases.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    held = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    rest = phrases.join(held, ["lang", "phrase"], "left")
    return rest.where(F.col("longer").isNull() | (100 * F.col("longer") < share_percent * F.col("a"))).drop("longer")


def collocations(
    docs: DataFrame, words: int = 3, min_count: int = 10, share_percent: int = 50, top: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` phrases.

    ``docs``: text, lang; other columns are not read. A-Z are lower-cased; words stand between
    spaces and tabs, phrases between ``.,;:!?`` and line ends. A phrase of 2 to ``words`` (2 or 3)
    words is a candidate if found ``min_count`` times; a is its count, l and r are those of the
    two parts of its lowest-scoring cut (the earliest of equals), score is 1000000 a a / (l r),
    rounded down. It is dropped if a longer candidate holds it with ``share_percent`` of its count
    or more. Ranks go by score, then a, then the phrase's bytes. A null lang is ``und``; null and
    empty texts have no words; repeated rows count each; an empty table gives an empty result.
    """
    if words not in (2, 3):
        raise ValueError("phrases of up to 2 or 3 words are counted")
    counts = stored(phrase_counts(docs, words, min_count))
    kept = without_parts(stored(scored_phrases(counts, words)), words, share_percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are ranked in parts before the parts' first ones meet
    part = Window.partitionBy("lang", "part").orderBy(*order)
    firsts = (
        kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
        .withColumn("rank", F.row_number().over(part))
        .where(F.col("rank") <= top)
    )
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = counts.where("words = 0 AND lang IS NOT NULL").select("lang", "n")
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
