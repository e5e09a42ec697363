"""One row per group: latest record, preferred row, top row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracebook.fixed_values import NATURAL_KEY

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every group in the given order.

    Catalyst turns ``row_number() = 1`` into a group limit below the shuffle, so each map
    task sends at most one row per key and a key with a third of all rows costs no more
    than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = NATURAL_KEY,
    recency: str = "extraction_timestamp",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The most recent row per key; equal times are settled by the tie-break columns.

    Without explicit ``tie_break`` all other columns are used, which makes the pick
    independent of arrival order.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c != recency]
    order = [F.col(recency).desc(), *(F.col(c).desc() for c in tie_break)]
    return first_per_key(df, keys, order)


def preferred_first(
    df: DataFrame, keys: Sequence[str], preferred: Column, order_by: Sequence[Column]
) -> DataFrame:
    """First row for which ``preferred`` holds, else the first row, per key."""
    ranked = F.when(F.coalesce(preferred, F.lit(False)), 0).otherwise(1)
    return first_per_key(df, keys, [ranked.asc(), *order_by])


def top_one(df: DataFrame, value: str, name: str) -> DataFrame:
    """The row with the largest value; nulls come last, the name settles ties."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(name).asc()).limit(1)
