"""Column helpers of the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, however often lambdas in it use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def space_words(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D."""
    return F.filter(F.split(text, SPACE), lambda word: word != "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased for matching ASCII words.

    ``lower`` folds one character from outside ASCII into it, the Kelvin sign, so texts that
    have it take the way by a translation of letters.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.contains(text, F.lit("K")), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))
