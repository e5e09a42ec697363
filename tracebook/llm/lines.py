"""Quality rules on words and lines, with line frequencies across the documents of a host.

DataFrame functions only. A line that many different documents of a host carry is that host's
furniture; words on such lines do not count as a document's own, and a document that has too few
words of its own is rejected.

Lines are counted by hash, one row per host, line and document that has it; the count is summed
on the map side before each shuffle, so a line that a third of all documents carry is a few rows
per task. Copies should not make their own lines look like furniture: documents of a host whose
whole normalised texts are equal count as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.llm.common import stored
from tracebook.llm.native import let, space_words

SYMBOLS = "#*$%&|<>"


def repeated_window_words(words: Column, size: int = 8) -> Column:
    """Words inside windows of ``size`` words found twice or more, the first find included."""

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - size)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))

    def covered(found: Column) -> Column:
        in_order = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(rows: Column) -> Column:
            def again(row: Column, k: Column) -> Column:
                here = row["h"]
                return here.eqNullSafe(F.get(rows, k - 1)["h"]) | here.eqNullSafe(F.get(rows, k + 1)["h"])

            return F.array_sort(F.transform(F.filter(rows, again), lambda row: row["i"]))

        def union(starts: Column) -> Column:
            steps = F.transform(
                starts, lambda at, k: F.least(F.coalesce(F.get(starts, k + 1), at + size) - at, F.lit(size))
            )
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        return let(let(in_order, twice), union)

    def counted(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) < F.size(found), covered(found)).otherwise(0)

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) > size, let(let(hashes, windows), counted)).otherwise(0)


def base_columns(text: Column) -> list[Column]:
    """The counts of one text; a null text has no words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).alias("n_words"), repeated_window_words(words).alias("n_repeat_words"))

    return [
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
        let(space_words(text), of_words).alias("by_words"),
    ]


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def normal_line(line: Column) -> Column:
    """A line with letter case, digits and spacing set aside."""
    plain = F.regexp_replace(F.lower(line), "[0-9]+", "0")
    return F.trim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " "))


def hashed_lines(text: Column) -> Column:
    """Lines with a word as (line, words), in order."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), normal_line)
    return F.transform(
        F.filter(lines, lambda line: line != ""),
        lambda line: F.struct(
            F.xxhash64(line).alias("line"),
            F.size(F.split(line, " ")).alias("words"),
        ),
    )


def measured(docs: DataFrame, host: str) -> DataFrame:
    """One row per document: its counts, its hashed lines and what it is counted as on its host."""
    text = F.col("text")
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", host, "text").alias("row_key"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        *base_columns(text),
        hashed_lines(text).alias("lines"),
    )
    return read.select(
        "doc_id", "row_key", "host", "word_chars", "n_symbols", "n_dup_lines",
        F.col("by_words.n_words").cast("long").alias("n_words"),
        F.col("by_words.n_repeat_words").cast("long").alias("n_repeat_words"),
        "lines",
    )


def frequent_lines(rows: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(host, line, n_docs) of lines in more than ``min_docs`` and ``max_share`` of a host's documents.

    Documents with the same lines in the same order are one document.
    """
    whole = F.xxhash64(F.transform("lines", lambda x: x["line"]))
    seen = rows.where(F.size("lines") > 0).select("host", whole.alias("counted_as"), "lines")
    hosts = seen.groupBy("host").agg(F.count_distinct("counted_as").alias("host_docs"))
    own = F.array_distinct(F.transform("lines", lambda x: x["line"]))
    counts = (
        seen.select("host", "counted_as", F.explode(own).alias("line"))
        .groupBy("host", "line")
        .agg(F.count_distinct("counted_as").alias("n_docs"))
        .where(F.col("n_docs") > min_docs)
    )
    return (
        counts.join(hosts, "host")
        .where(F.col("n_docs") > max_share * F.col("host_docs"))
        .select("host", "line", "n_docs")
    )


def furniture(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(row_key, dropped): per document the hashes of its lines that are frequent on its host."""
    own = F.array_distinct(F.transform("lines", lambda x: x["line"]))
    return (
        rows.select("row_key", "host", F.explode(own).alias("line"))
        .join(frequent.select("host", "line"), ["host", "line"])
        .groupBy("row_key")
        .agg(F.collect_set("line").alias("dropped"))
    )


def without_lines(docs: DataFrame, dropped: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` with ``text`` freed of the lines that ``furniture`` names for each row."""
    gone = F.col("gone.dropped")
    kept = F.filter(F.split("d.text", "\n"), lambda x: ~F.array_contains(gone, F.xxhash64(normal_line(x))))
    text = F.when(gone.isNull(), F.col("d.text")).otherwise(F.array_join(kept, "\n"))
    key = F.xxhash64(F.col("d.doc_id"), F.col(f"d.`{host}`"), F.col("d.text")) == F.col("gone.row_key")
    return docs.alias("d").join(dropped.alias("gone"), key, "left").select(
        *[text.alias("text") if name == "text" else F.col(f"d.`{name}`") for name in docs.columns]
    )


def line_verdicts(
    docs: DataFrame,
    host: str = "source",
    min_docs: int = 20,
    max_share: float = 0.02,
    min_own_percent: int = 30,
    min_words: int = 20,
    max_repeat_percent: int = 30,
) -> DataFrame:
    """Word and line counts of every document, and whether it is kept.

    ``docs``: doc_id, text and the column ``host``; others are not read. A line is furniture if
    more than ``min_docs`` and more than ``max_share`` of its host's documents carry it (see
    ``frequent_lines``); n_own_words are the words on other lines. A document is kept unless it
    fails the base rules or fewer than ``min_own_percent`` of its words are its own. A null or
    empty text has no words and fails; a null host is the host with the empty name; repeated rows
    get a verdict each and count as one document; an empty table gives an empty result.
    """
    rows = stored(measured(docs, host))
    dropped = furniture(rows, frequent_lines(rows, min_docs, max_share))
    gone = F.filter("lines", lambda x: F.array_contains(F.col("dropped"), x["line"]))
    lost = F.aggregate(gone, F.lit(0), lambda total, x: total + x["words"])
    own = F.col("n_words") - F.coalesce(lost, F.lit(0))
    return (
        rows.join(dropped, "row_key", "left")
        .select("*", own.cast("long").alias("n_own_words"))
        .withColumn("base_failed", base_failed(min_words, max_repeat_percent))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & (100 * F.col("n_own_words") >= min_own_percent * F.col("n_words"))).alias("kept"),
            "n_own_words",
        )
    )
