"""Columns that are worth computing once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that filters above will read instead of computing them again.

    A filter is pushed below a projection by putting the projected expressions into it; a
    long expression is then evaluated twice, and a chain of them grows with every step.
    Filters on what a generator produces stay above it, so the columns come out of an
    ``inline`` over a single row. Filters on other columns still pass.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
