"""Display forms of values, scores, codes and times."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracebook.fixed_values import MODEL_LABELS, PREVIEW_CHARS, TOPIC_LABELS
from tracebook.schemas import VALUE_TYPE

# fixed values: separators of French and English number forms
NARROW_NO_BREAK_SPACE = "\u202f"
FRENCH_SEPARATORS = NARROW_NO_BREAK_SPACE + ","
DASH = "—"
ELLIPSIS = "…"


def _formatted(value: Column, pattern: str) -> Column:
    return F.call_function("format_number", value, F.lit(pattern))


def french_number(value: Column) -> Column:
    """Grouped by thousands, decimal comma, at most three decimals."""
    rounded = F.round(value.cast(VALUE_TYPE), 3)
    return F.translate(_formatted(rounded, "#,##0.###"), ",.", FRENCH_SEPARATORS)


def plain_number(value: Column) -> Column:
    """Digits without grouping and without trailing zeros."""
    return _formatted(value.cast(VALUE_TYPE), "0.######")


def metric_value(value_numeric: Column, value_text: Column, unit: Column) -> Column:
    """Number (grouped from 1000 on) with its unit, else the text, else a dash."""
    number = F.when(F.abs(value_numeric) >= 1000, french_number(value_numeric)).otherwise(
        plain_number(value_numeric)
    )
    with_unit = F.when(F.coalesce(unit, F.lit("")) == "", number).otherwise(
        F.concat_ws(" ", number, unit)
    )
    return F.when(value_numeric.isNotNull(), with_unit).otherwise(
        F.coalesce(value_text, F.lit(DASH))
    )


def eur_millions(value: Column) -> Column:
    """English thousands with currency sign and million mark."""
    return F.concat(F.lit("€"), _formatted(value.cast(VALUE_TYPE), "#,##0.###"), F.lit("M"))


def percent(score: Column) -> Column:
    """One decimal and a percent sign."""
    return F.format_string("%.1f%%", (score * 100).cast("double"))


def labelled(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code, null for an unknown code."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.element_at(F.create_map(*pairs), code)


def topic_label(topic: Column) -> Column:
    return labelled(topic, TOPIC_LABELS)


def model_label(model: Column) -> Column:
    """Short model label; every model but the first counts as the second."""
    first, second = MODEL_LABELS
    return F.when(model == first, MODEL_LABELS[first]).otherwise(MODEL_LABELS[second])


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def preview(text: Column, limit: int = PREVIEW_CHARS) -> Column:
    """The head of a text, with an ellipsis when something was left out."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(ELLIPSIS))
    ).otherwise(text)
