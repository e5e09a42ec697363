"""Which passages of one table stand, as plain substrings, in the texts of another?"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD_RUNS = (1, 4)
_CHARACTER_RUNS = (1, 2, 3)


def _words(text: Column) -> Column:
    return F.split(text, r"[ \t\n\r\f]+")


def _characters(text: Column) -> Column:
    return F.split(text, "")


def _run_hash(run: list[Column]) -> Column:
    """Hash of a run of tokens; its length is part of the hash."""
    return F.xxhash64(F.lit(len(run)), *run)


def _anchored_texts(
    texts: DataFrame, text_id: str, tokens: Callable[[Column], Column], lengths: tuple[int, ...]
) -> DataFrame:
    """``text_id, __anchor``: hashes of all runs of the given lengths in every text."""
    longest = max(lengths)
    cut = texts.select(text_id, tokens(F.col("__lower")).alias("__tokens"))
    shifted = [
        F.slice("__tokens", offset + 1, F.greatest(F.size("__tokens") - offset, F.lit(0))).alias(
            f"t{offset}"
        )
        for offset in range(longest)
    ]
    neighbours = cut.select(text_id, F.inline(F.arrays_zip(*shifted)))
    hashes = F.array(
        *[
            F.when(
                F.col(f"t{n - 1}").isNotNull(), _run_hash([F.col(f"t{i}") for i in range(n)])
            )
            for n in lengths
        ]
    )
    return neighbours.select(text_id, F.explode(hashes).alias("__anchor")).where(
        F.col("__anchor").isNotNull()
    )


def _anchor_of(tokens: Column, lengths: tuple[int, ...]) -> Column:
    """Hash of the passage's anchor: of the longest runs that fit, the one with most text."""

    def best(n: int) -> Column:
        runs = F.transform(
            F.sequence(F.lit(1), F.size(tokens) - n + 1),
            lambda start: F.struct(
                F.length(F.array_join(F.slice(tokens, start, n), "")).alias("chars"),
                F.slice(tokens, start, n).alias("run"),
            ),
        )
        run = F.array_max(runs)["run"]
        return _run_hash([F.get(run, F.lit(i)) for i in range(n)])

    anchor = F.when(F.size(tokens) >= lengths[0], best(lengths[0]))
    for n in lengths[1:]:
        anchor = F.when(F.size(tokens) >= n, best(n)).otherwise(anchor)
    return anchor


def containment_pairs(
    texts: DataFrame,
    passages: DataFrame,
    text_id: str,
    passage_id: str,
    text: str = "text",
    passage: str = "passage",
) -> DataFrame:
    """All pairs whose lower-cased text contains the lower-cased passage.

    Exact, without comparing every text with every passage. The inner words of a passage
    (all but the first and the last) have white space on both sides, so a text that
    contains the passage contains them as whole words. A run of four inner words (or one
    word, if there are fewer than four) is the passage's anchor; texts and passages meet on
    the hash of that run, as narrow rows of ids, and ``contains`` decides. Passages of one or
    two words have no inner word; they meet on a run of up to three characters instead.
    """
    lowered = texts.select(text_id, F.lower(F.col(text)).alias("__lower"))
    members = passages.select(passage_id, F.lower(F.col(passage)).alias("__passage"))
    # equal passages are sought once, under one of their ids
    sought = members.groupBy("__passage").agg(F.min(passage_id).alias("__one"))
    words = _words(F.col("__passage"))
    inner = sought.withColumn(
        "__inner",
        F.when(F.size(words) > 2, F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))),
    )
    # 4 or 1: words in the anchor; 0: no inner word
    kind = F.when(F.col("__inner").isNull(), 0).when(F.size("__inner") >= 4, 4).otherwise(1)
    sorted_out = inner.where(F.length("__passage") > 0).withColumn("__kind", kind)
    # texts are cut only for kinds that occur, which the running query finds out by itself
    kinds = sorted_out.agg(F.collect_set("__kind")).scalar()

    def meeting(
        of_kind: int, tokens: Callable[[Column], Column], lengths: tuple[int, ...], among: Column
    ) -> DataFrame:
        anchors = sorted_out.where(F.col("__kind") == of_kind).select(
            "__one", _anchor_of(among, lengths).alias("__anchor")
        )
        searched = lowered.where(F.array_contains(kinds, of_kind))
        return _anchored_texts(searched, text_id, tokens, lengths).join(anchors, "__anchor")

    letters = _characters(F.col("__passage"))
    met = [meeting(n, _words, (n,), F.col("__inner")) for n in _WORD_RUNS]
    met.append(meeting(0, _characters, _CHARACTER_RUNS, letters))
    pairs = reduce(DataFrame.unionByName, met)
    candidates = pairs.select(text_id, "__one").distinct()
    found = (
        candidates.join(sought, "__one")
        .join(lowered, text_id)
        .where(F.contains(F.col("__lower"), F.col("__passage")))
        .select(text_id, "__passage")
    )
    return found.join(members, "__passage").select(text_id, passage_id)
