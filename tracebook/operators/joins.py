"""Registry and work-list joins.

No join in the package forces a broadcast. Spark sends a side to every executor only when
its estimated size, or under adaptive execution its measured size, is below
``spark.sql.autoBroadcastJoinThreshold``. Beyond that the join shuffles on its key and
adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.functions.keys import file_key

def landed_reports(registry: DataFrame, landed: DataFrame, fiscal_year: int) -> DataFrame:
    """Registry entries that have a landed file ``(file_key, path)``, with the path."""
    keyed = registry.withColumn("file_key", file_key("ticker", F.lit(fiscal_year)))
    return keyed.join(landed.select("file_key", "path"), "file_key")


def with_data(entities: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """Entities that have at least one fact.

    The fact keys are made distinct first: that combines before the shuffle, whereas the
    right side of a semi-join with a hot key could not be split.
    """
    return entities.join(facts.select(on).distinct(), on, "left_semi")


def pending(entities: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """Entities without any fact."""
    return entities.join(facts.select(on).distinct(), on, "left_anti")


def lookup(entities: DataFrame, facts: DataFrame, on: str, value: object) -> DataFrame:
    """Point lookup: nothing for an unknown key, one empty row for a known key without facts."""
    chosen = entities.where(F.col(on) == F.lit(value))
    return chosen.join(facts.where(F.col(on) == F.lit(value)), on, "left")


def work_list(entities: DataFrame, items: Sequence[object], name: str = "topic") -> DataFrame:
    """Every (entity, item) attempt, items in the given order.

    The item list is short and fixed, so it is written into each row and unfolded in
    place; no join takes part.
    """
    listed = F.array(*[F.lit(item) for item in items])
    return entities.select("*", F.posexplode(listed).alias(f"{name}_position", name))


def stamp_company(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Put ticker, name and language of the registry onto records by ``report_id``."""
    company = registry.select("report_id", "ticker", "name", "language")
    return records.join(company, "report_id")


def resolve_report_url(registry: DataFrame, fiscal_year: int) -> tuple[DataFrame, DataFrame]:
    """(entries with ``report_url`` and ``target``, entries whose URL is not known)."""
    target = F.concat(file_key("ticker", F.lit(fiscal_year)), F.lit(".pdf"))
    known = F.col("known_report_url").isNotNull()
    resolved = registry.where(known).select(
        "*", F.col("known_report_url").alias("report_url"), target.alias("target")
    )
    unresolved = registry.where(~known).withColumn(
        "error", F.concat(F.lit("no report URL known for "), F.col("ticker"))
    )
    return resolved, unresolved


def left_with_default(
    left: DataFrame, right: DataFrame, on: str, value: str, default: object
) -> DataFrame:
    """Left join of one value column, missing values replaced by the default."""
    joined = left.join(right.select(on, value), on, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Does the (already lower-cased) text contain one of the words as a plain substring?"""
    hits = [F.contains(text, F.lit(word)) for word in words]
    result = hits[0]
    for hit in hits[1:]:
        result = result | hit
    return result
