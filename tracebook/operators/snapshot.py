"""Nested snapshot: one document per company, long companies in several parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.fixed_values import DEFAULT_FISCAL_YEAR, EXPORT_ORDER
from tracebook.operators.numbering import number_by_range, number_within
from tracebook.operators.picks import latest_per_key

PART_SIZE = 10_000


def nested_documents(
    df: DataFrame,
    key: str,
    order_by: Sequence[Column],
    fields: Mapping[str, Column],
    blocks: Sequence[Column] = (),
    part_size: int = PART_SIZE,
) -> DataFrame:
    """``key, part, item_count, items``: the ordered rows of each key as JSON arrays.

    Every item starts with ``id`` = key, dash, running number. A document holds at most
    ``part_size`` items; a longer key goes on in parts 1, 2, …, so that no single row has
    to hold a hot key. All parts in turn are the whole array.
    """
    numbered = number_within(df, [key], order_by, "__number", blocks)
    item = F.struct(
        "__number",
        F.struct(
            F.concat_ws("-", F.col(key).cast("string"), F.col("__number").cast("string")).alias(
                "id"
            ),
            *[value.alias(name) for name, value in fields.items()],
        ).alias("entry"),
    )
    part = F.floor(F.col("__number") / part_size).cast("long")
    entries = F.transform(
        F.sort_array(F.collect_list("__item")), lambda e: e["entry"]
    )
    return (
        numbered.select(key, part.alias("part"), item.alias("__item"))
        .groupBy(key, "part")
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            F.to_json(entries, {"ignoreNullFields": "false"}).alias("items"),
        )
    )


def _metric_fields() -> dict[str, Column]:
    return {
        "esrsTopic": F.col("esrs_topic"),
        "esrsDisclosure": F.col("esrs_disclosure"),
        "metricName": F.col("metric_name"),
        "valueNumeric": F.col("value_numeric").cast("double"),
        "valueText": F.col("value_text"),
        "unit": F.col("unit"),
        "confidenceScore": F.col("confidence_score").cast("double"),
        "sourcePage": F.col("source_page").cast("int"),
        "sourceSnippet": F.col("source_snippet"),
        "language": F.col("language"),
        "extractionModel": F.col("extraction_model"),
    }


def staged_year(raw: DataFrame, fiscal_year: int = DEFAULT_FISCAL_YEAR) -> DataFrame:
    """Latest row per natural key of one fiscal year; the year filter is pushed into the scan."""
    return latest_per_key(raw.where(F.col("fiscal_year") == fiscal_year))


def disclosure_documents(
    raw: DataFrame, fiscal_year: int = DEFAULT_FISCAL_YEAR, part_size: int = PART_SIZE
) -> DataFrame:
    """Documents of one fiscal year: its latest rows, numbered per ticker in the export order."""
    order = [F.col(c).asc() for c in EXPORT_ORDER[1:]]
    return nested_documents(
        staged_year(raw, fiscal_year), "company_ticker", order, _metric_fields(), part_size=part_size
    )


def snapshot_header(companies: DataFrame, fiscal_year: int, warehouse: str) -> DataFrame:
    """Header document: year, time of export, source name, and the company array by ticker.

    The registry holds at most a few hundred companies, so its array fits one row.
    """
    entry = F.struct("ticker", "name", "sector", "country", "language")
    listed = companies.agg(F.sort_array(F.collect_list(entry)).alias("companies"))
    header = F.struct(
        F.lit(fiscal_year).alias("fiscalYear"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(
            "extractedAt"
        ),
        F.lit(warehouse).alias("warehouse"),
        F.col("companies"),
    )
    return listed.select(F.to_json(header, {"ignoreNullFields": "false"}).alias("header"))
