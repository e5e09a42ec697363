"""Confidence scores and the checks of a value against its cited text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.fixed_values import (
    CONFIDENCE_THRESHOLD,
    LANGUAGE_PENALTY,
    LOGPROB_SPAN,
    MISSING_RATING,
    SNIPPET_PENALTY,
)
from tracebook.functions.once import computed_once
from tracebook.schemas import SCORE_TYPE, VALUE_TYPE

# 2**27 + 1: splits a double into two halves whose products with small integers are exact
_SPLIT = 134217729.0
# 2**53: doubles from here on have no fraction
_BIG = 9007199254740992.0
_UNITS = "decimal(38,0)"


def clamp_unit(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def with_exact_units(df: DataFrame, units: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Add columns ``name`` = a double column (>= 0) in units of 10**-digits, as decimal(38,0).

    Rounding looks at the exact binary value: 0.4125 is stored a little below the tie and
    gives 412, true ties go to the even neighbour. ``F.round`` works on the shortest decimal
    text instead and would give 413. A double of any size is its whole part and a fraction,
    both exact; only the fraction is rounded. From 1e35 on the result is null. The steps are
    separate projections, so each is computed once per row inside one generated stage.
    """
    sources = sorted({source for source, _ in units.values()})
    whole, rest = "__whole_{}".format, "__rest_{}".format
    wholes = {whole(x): F.when(F.col(x) < _BIG, F.floor(x).cast("double")).otherwise(F.col(x)) for x in sources}
    rests = {rest(x): F.col(x) - F.col(whole(x)) for x in sources}
    split = {
        f"__high_{x}": F.lit(_SPLIT) * F.col(rest(x)) - (F.lit(_SPLIT) * F.col(rest(x)) - F.col(rest(x)))
        for x in sources
    }
    exact = {f"__exact_{x}": _as_decimal(F.col(whole(x))) for x in sources}
    floors = {
        f"__floor_{name}": F.floor(F.col(rest(x)) * float(10**digits)).cast("double")
        for name, (x, digits) in units.items()
    }
    beyond = {
        f"__beyond_{name}": (F.col(f"__high_{x}") * float(10**digits) - (F.col(f"__floor_{name}") + 0.5))
        + (F.col(rest(x)) - F.col(f"__high_{x}")) * float(10**digits)
        for name, (x, digits) in units.items()
    }
    rounded = {}
    for name, (x, digits) in units.items():
        floor, over = F.col(f"__floor_{name}"), F.col(f"__beyond_{name}")
        # a whole part in units is even but for units of one
        odd = floor % 2 if digits else F.col(whole(x)) % 2
        up = F.when(over > 0, 1).when(over < 0, 0).otherwise(odd)
        scaled = (F.col(f"__exact_{x}") * 10**digits).cast(_UNITS)
        rounded[name] = (scaled + (floor + up).cast("long")).cast(_UNITS)
    staged = df.withColumns(wholes).withColumns(rests).withColumns({**split, **floors, **exact})
    staged = staged.withColumns(beyond).withColumns(rounded)
    return staged.drop(*wholes, *rests, *split, *floors, *exact, *beyond)


def _as_decimal(whole: Column) -> Column:
    """The exact integer that a double holds; a cast would take its shortest decimal text."""
    limb = float(2**40)
    low = whole % limb  # remainders of doubles are exact
    middle = (whole - low) / limb % limb
    top = ((whole - low) / limb - middle) / limb
    digits = F.lit(0).cast(_UNITS)
    for part in (top, middle, low):
        digits = (digits * F.lit(2**40) + part.cast("long")).cast(_UNITS)
    return F.when(whole < _BIG, whole.cast("long").cast(_UNITS)).when(whole < 1e35, digits)


def pseudo_logprob(rating: Column) -> Column:
    """A self-rating in [0, 1] mapped to [-5, 0]; a missing rating counts as 0.5."""
    rated = clamp_unit(F.coalesce(rating.cast("double"), F.lit(MISSING_RATING)))
    return F.lit(-LOGPROB_SPAN) * (F.lit(1.0) - rated)


def with_confidence(
    df: DataFrame,
    name: str,
    logprob: Column,
    structural: Column,
    snippet_match: Column,
    language_match: Column,
) -> DataFrame:
    """Add a score in [0, 1] with three decimals; 0 when the record is structurally invalid."""
    base = clamp_unit((logprob + LOGPROB_SPAN) / LOGPROB_SPAN)
    cited = F.when(snippet_match, F.col("__base")).otherwise(F.col("__base") * SNIPPET_PENALTY)
    spoken = F.when(language_match, F.col("__cited")).otherwise(
        F.col("__cited") * LANGUAGE_PENALTY
    )
    staged = (
        df.withColumn("__base", base).withColumn("__cited", cited).withColumn("__spoken", spoken)
    )
    rounded = with_exact_units(staged, {"__thousandths": ("__spoken", 3)})
    score = F.when(structural, F.col("__thousandths").cast("double") / 1000.0).otherwise(F.lit(0.0))
    return computed_once(rounded, {name: score.cast(SCORE_TYPE)}).drop(
        "__base", "__cited", "__spoken", "__thousandths"
    )


def band(score: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    """Label from the score alone; the border value belongs to ``published``."""
    return F.when(score >= F.lit(str(threshold)).cast(SCORE_TYPE), "published").otherwise("review")


def _digits_only(negative: Column, units: Column, digits: int) -> Column:
    """The fixed-point text of a number with its decimal point taken out."""
    text = units.cast("string")
    padded = text if digits == 0 else F.when(
        F.length(text) <= digits, F.lpad(text, digits + 1, "0")
    ).otherwise(text)
    return F.concat(F.when(negative, "-").otherwise(""), padded)


def with_snippet_match(
    df: DataFrame,
    name: str,
    snippet: Column,
    value_numeric: Column,
    value_text: Column,
    strict: bool = True,
) -> DataFrame:
    """Extraction-time check: add whether the value is written in the cited snippet.

    Numbers are looked for with 0, 1 and 2 decimals, without separators, in the snippet
    without commas and spaces; text by case-insensitive containment. ``strict=False`` also
    takes dots and every other kind of white space out of the snippet.
    """
    if strict:
        plain = F.translate(F.lower(snippet), ", ", "")
    else:
        plain = F.regexp_replace(F.lower(snippet), r"(?U)[.,'\s]", "")
    staged = df.withColumns(
        {
            "__plain": plain,
            "__size": F.abs(value_numeric.cast("double")),
            "__negative": value_numeric < 0,
            "__text_hit": F.contains(F.lower(snippet), F.lower(value_text)),
            "__is_text": value_text.isNotNull(),
        }
    )
    rounded = with_exact_units(staged, {f"__units_{k}": ("__size", k) for k in (0, 1, 2)})
    forms = [_digits_only(F.col("__negative"), F.col(f"__units_{k}"), k) for k in (0, 1, 2)]
    numeric_hit = (
        F.contains(F.col("__plain"), forms[0])
        | F.contains(F.col("__plain"), forms[1])
        | F.contains(F.col("__plain"), forms[2])
    )
    found = (
        F.when(F.col("__size").isNotNull(), F.coalesce(numeric_hit, F.lit(False)))
        .when(F.col("__is_text"), F.col("__text_hit"))
        .otherwise(F.lit(False))
    )
    return computed_once(rounded, {name: found}).drop(
        "__plain", "__size", "__negative", "__text_hit", "__is_text",
        *[f"__units_{k}" for k in (0, 1, 2)],
    )


def value_missing_from_source(
    snippet: Column, value_numeric: Column, value_text: Column
) -> Column:
    """Warehouse-time check, true when the value does not appear in the cited text.

    The integer form rounds half away from zero and is looked for without separators; the
    full decimal form is looked for in the raw snippet. No value at all counts as failing.
    """
    number = value_numeric.cast(VALUE_TYPE)
    integer_form = F.round(number, 0).cast("decimal(28,0)").cast("string")
    numeric_hit = F.contains(F.translate(snippet, ", ", ""), integer_form) | F.contains(
        snippet, number.cast("string")
    )
    return (
        F.when(number.isNotNull(), ~numeric_hit)
        .when(value_text.isNotNull(), ~F.contains(F.lower(snippet), F.lower(value_text)))
        .otherwise(F.lit(True))
    )
