"""Record rules: one Boolean column per rule, collected into a ``violations`` array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracebook.fixed_values import LANGUAGES, MODELS, TOPICS
from tracebook.functions.once import computed_once
from tracebook.schemas import VALUE_TYPE

Rules = dict[str, Column]

# fixed value: the longest URL a registry entry may have
URL_LIMIT = 2083


def length_between(c: str, low: int, high: int) -> Column:
    return F.length(F.col(c)).between(low, high)


def not_blank(c: str) -> Column:
    """Holds some non-white-space character (white space in the Unicode sense)."""
    return F.col(c).rlike(r"(?U)\S")


def exactly_one(first: str, second: str) -> Column:
    return F.col(first).isNull() != F.col(second).isNull()


def http_url(c: str) -> Column:
    return F.col(c).rlike(r"^(?i)https?://[^\s/?#]+\S*\z") & (F.length(c) <= URL_LIMIT)


def record_rules() -> Rules:
    """Rules of a flattened disclosure record."""
    return {
        "company_ticker_length": length_between("company_ticker", 2, 10),
        "fiscal_year_range": F.col("fiscal_year").between(2020, 2030),
        "esrs_topic_value": F.col("esrs_topic").isin(*TOPICS),
        "esrs_disclosure_length": length_between("esrs_disclosure", 3, 20),
        "metric_name_length": length_between("metric_name", 3, 200),
        "exactly_one_value": exactly_one("value_numeric", "value_text"),
        "confidence_score_range": F.col("confidence_score").between(0, 1),
        "source_page_min": F.col("source_page") >= 1,
        "source_snippet_length": length_between("source_snippet", 20, 500),
        "source_snippet_blank": not_blank("source_snippet"),
        "language_value": F.col("language").isin(*LANGUAGES),
        "extraction_model_value": F.col("extraction_model").isin(*MODELS),
    }


def landing_limits() -> Rules:
    """Column lengths of the landing table that the record rules leave open."""
    return {
        f"{column}_limit": F.col(column).isNull() | (F.length(F.col(column)) <= limit)
        for column, limit in {"value_text": 500, "unit": 50}.items()
    }


def type_limits() -> Rules:
    """Whether a number as it came fits the landing column that it is meant for."""
    return {
        f"{column}_fits": F.col(column).isNull() | F.col(column).try_cast(kind).isNotNull()
        for column, kind in {"value_numeric": VALUE_TYPE, "source_page": T.IntegerType()}.items()
    }


def registry_rules() -> Rules:
    """Rules of a company registry entry; the report URL may be missing."""
    return {
        "ticker_length": length_between("ticker", 2, 10),
        "name_length": length_between("name", 2, 100),
        "sector_length": length_between("sector", 2, 50),
        "country_code": F.col("country").rlike(r"^[A-Z]{2}\z"),
        "language_code": F.col("language").rlike(r"^(fr|en)\z"),
        "ir_page_url_http": http_url("ir_page_url"),
        "known_report_url_http": F.col("known_report_url").isNull() | http_url("known_report_url"),
    }


def violations(rules: Rules) -> Column:
    """Names of the rules a row breaks; a rule that evaluates to null is broken."""
    broken = [
        F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()
    ]
    return F.filter(F.array(*broken), lambda name: name.isNotNull())


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows with their ``violations``."""
    return computed_once(df, {"violations": violations(rules)})


def split_valid(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with their violations)."""
    checked = validate(df, rules)
    clean = F.size("violations") == 0
    return checked.where(clean).drop("violations"), checked.where(~clean)
