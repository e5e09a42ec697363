"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chosen_rows(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, max_chars: int | None = None
) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each class, the same ones every time.

    Ids are picked from the labels by hash, then rows by the hash of their texts, as an id may
    have any number of them; whole texts move only for the rows picked. Equal rows count once.
    Texts over ``max_chars`` are left out, not cut.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = _of_each_class(known, order, per_class)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    if max_chars is not None:
        texts = texts.where(F.length("text") <= max_chars)
    named = texts.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    # two times ``per_class`` ids at most, and then as many rows
    found = named.select("doc_id", "hash").join(F.broadcast(ids), "doc_id").distinct()
    rows = _of_each_class(found, [F.xxhash64("doc_id", "hash"), F.col("doc_id"), F.col("hash")], per_class)
    return (
        named.join(F.broadcast(rows), ["doc_id", "hash"])
        .groupBy("doc_id", "hash", "label")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "label")
    )


def _of_each_class(rows: DataFrame, order: list[Column], per_class: int) -> DataFrame:
    first, second = (rows.where(F.col("label") == value).orderBy(*order).limit(per_class) for value in (0, 1))
    return first.union(second)
