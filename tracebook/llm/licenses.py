"""License notices: exact phrases, and an exact set-similarity join with notice templates.

DataFrame functions only. A text block is any run of consecutive words of a text as wide as the
template at hand allows: size / ``threshold`` words, wherever lines end and whatever comment signs
stand between, so hard-wrapped notices are blocks too. A block holds a template if at least
``threshold`` of the template's distinct words are in it.

Texts are read once. What is stored of a text are its counts, its phrases and, where it has enough
words of some template at all (length filter over the text), the places of template words. Words are
ordered by how many texts have them, rarest first. Places are dealt to spans of two times the widest
block that overlap by half, so that every block lies in one; a span that holds a template shares
one of the first ``size - needed + 1`` words of it (prefix filter), has at least ``needed`` words
(length filter), and the words that follow the shared one in both orders must still reach
``needed`` (positional filter). In the spans left every block is compared in full, so none above
the threshold is missed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.llm.common import stored
from tracebook.llm.native import ascii_lower

# what is neither a word nor a space becomes a space
BETWEEN = r"[\x00-\x1F\x21-\x2F\x3A-\x60\x7B-\x7F]"

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices as their licenses or stewards word them, and their labels.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis without warranties or conditions of any kind either express or implied", "apache-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("you should have received a copy of the gnu affero general public license along with this program", "agpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("all rights reserved", "all-rights-reserved"),
]


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def width(template: str, threshold: float) -> int:
    """Words of a block that may hold the template."""
    return math.floor(len(template.split()) / threshold + 1e-9)


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII punctuation, white space and controls, A-Z lower-cased."""
    plain = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN, " ")
    return F.array_remove(F.split(plain, " "), "")


def literals(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def phrase_starts(words: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one after the other."""
    parts = phrase.split()

    def here(at: Column) -> Column:
        same = F.get(words, at) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & (F.get(words, at + k) == part)
        return F.coalesce(same, F.lit(False))

    # texts that have all its words, which few have, are looked through
    held = F.lit(True)
    for part in sorted(set(parts), key=len):
        held = held & F.array_contains(words, part)
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    return F.when(held, places).otherwise(F.array().cast("array<int>"))


def read_texts(docs: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """One row per text: counts, phrases, which template words it has and, if they may do, where they stand."""
    sets = [sorted(set(text.split())) for text, _ in templates]
    vocabulary = sorted({word for words in sets for word in words})
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # two hashes name a text: one would let two of very many texts meet
        F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "doc_id", "text").alias("b")).alias("key"),
        words_of(F.col("text")).alias("words"),
    )
    found = words.select("*", F.array_intersect(literals(vocabulary), "words").alias("has"))
    enough = F.lit(False)
    for of_template in sets:
        shared = F.size(F.array_intersect("has", literals(of_template)))
        enough = enough | (shared >= needed(len(of_template), threshold))
    places = F.filter(
        F.transform("words", lambda word, at: F.struct(at.alias("at"), word.alias("word"))),
        lambda x: F.array_contains(literals(vocabulary), x["word"]),
    )
    return found.select(
        "doc_id", "key", "has",
        F.size("words").cast("long").alias("n_words"),
        *[phrase_starts(F.col("words"), phrase).alias(f"p{at}") for at, phrase in enumerate(PHRASES)],
        F.when(enough, places).alias("places"),
    )


def word_order(read: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary, the word of fewest texts first; equal ones by name."""
    counted = read.select(F.explode("has").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # one row per word of the templates at most
    seen = {r.word: r.n for r in counted.collect()}
    return sorted(vocabulary, key=lambda word: (seen.get(word, 0), word))


def held_templates(read: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(key, label, score): the templates that blocks of a text hold, with the largest share held."""
    spark = read.sparkSession
    sets = [(sorted(set(text.split())), label, width(text, threshold)) for text, label in templates]
    order = word_order(read, sorted({word for words, _, _ in sets for word in words}))
    place = {word: at for at, word in enumerate(order)}
    index = []
    for words, label, wide in sets:
        ordered = sorted(words, key=place.__getitem__)
        least = needed(len(ordered), threshold)
        for at, word in enumerate(ordered[: len(ordered) - least + 1]):
            index.append((word, label, at, least, wide, ordered))
    # as many rows as the templates have prefix words
    prefixes = spark.createDataFrame(
        index, "word string, label string, at int, least int, wide int, template_words array<string>"
    )
    step = max(wide for _, _, wide in sets)
    known = literals(order)
    at = F.floor(F.col("place.at") / step)
    spans = (
        read.where("places IS NOT NULL")
        .select("key", F.explode("places").alias("place"))
        .select("key", "place", F.explode(F.array(at - 1, at)).alias("span"))
        .groupBy("key", "span")  # two times ``step`` places at most
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
        .withColumn("ordered", F.array_intersect(known, F.col("places.word")))
    )
    candidates = spans.select("*", F.posexplode("ordered").alias("block_at", "word")).join(F.broadcast(prefixes), "word")
    after = F.least(F.size("template_words") - F.col("at"), F.size("ordered") - F.col("block_at"))
    left = candidates.where(F.size("ordered") >= F.col("least")).where(
        F.least("at", "block_at") + after >= F.col("least")
    )

    def shared(start: Column) -> Column:
        """Words of the template in the block that begins at a place."""
        inside = F.filter("places", lambda x: (x["at"] >= start["at"]) & (x["at"] < start["at"] + F.col("wide")))
        return F.size(F.array_intersect(F.transform(inside, lambda x: x["word"]), "template_words"))

    # a block with most words of a template can begin at one of them
    most = F.array_max(F.transform("places", shared))
    return (
        left.withColumn("shared", most)
        .where(F.col("shared") >= F.col("least"))
        .groupBy("key", "label")
        .agg(F.max(F.col("shared") / F.size("template_words")).alias("score"))
    )


def license_labels(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8
) -> DataFrame:
    """License labels of every document.

    ``docs``: doc_id, text; other columns are not read. Words are runs of characters other than
    ASCII punctuation, white space and controls, A-Z lower-cased. n_base counts the places of
    ``PHRASES``; first_word and last_word are the smallest and largest of them (null if none).
    labels adds the labels of the templates of which a block of consecutive words (as many as the
    template has, divided by ``threshold``) holds ``threshold`` or more of the distinct words;
    score is the largest such share, 1 where a phrase stands and 0 where there is neither. A null
    or empty text has no words and no labels; repeated rows get a row each; an empty table gives
    an empty result.
    """
    read = stored(read_texts(docs, templates, threshold))
    found = (
        held_templates(read, templates, threshold)
        .groupBy("key")
        .agg(F.collect_set("label").alias("held"), F.max("score").alias("share"))
    )
    starts = F.flatten(F.array(*[F.col(f"p{at}") for at in range(len(PHRASES))]))
    named = F.array_compact(
        F.array(*[F.when(F.size(f"p{at}") > 0, F.lit(label)) for at, label in enumerate(PHRASES.values())])
    )
    base = read.select("doc_id", "key", "places", "n_words", starts.alias("starts"), named.alias("named"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    none = F.array().cast("array<string>")
    # few texts have words enough of a template to be joined at all
    without = base.where("places IS NULL").select("*", none.alias("held"), F.lit(None).cast("double").alias("share"))
    held = F.coalesce("held", none)
    return base.where("places IS NOT NULL").join(found, "key", "left").unionByName(without).select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        joined(F.col("named")).alias("base_labels"),
        joined(F.concat("named", held)).alias("labels"),
        F.when(F.size("starts") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
