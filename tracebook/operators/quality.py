"""Data-quality checks. Each check yields its failing rows; passing means none."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.functions.scoring import value_missing_from_source


@dataclass(frozen=True)
class RowCheck:
    """A condition that single rows break."""

    name: str
    failing: Column


@dataclass(frozen=True)
class UniqueCheck:
    """No combination of the columns occurs twice.

    For a single column null is no value and passes; for several columns null is compared
    like a value.
    """

    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ParentCheck:
    """Every key that is not null has a parent row."""

    name: str
    column: str
    parent: DataFrame
    parent_column: str


@dataclass(frozen=True)
class DisjointCheck:
    """No key stands both in rows of the one and in rows of the other kind."""

    name: str
    column: str
    left: Column
    right: Column


Check = RowCheck | UniqueCheck | ParentCheck


@dataclass(frozen=True)
class CheckedTable:
    """The rows of a DataFrame that make up the table ``name``, and its checks."""

    name: str
    checks: Sequence[RowCheck | UniqueCheck | DisjointCheck]
    rows: Column | None = None


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null({column})", F.col(column).isNull())


def accepted_values(column: str, values: Sequence[object]) -> RowCheck:
    """Nulls pass."""
    return RowCheck(f"accepted_values({column})", ~F.col(column).isin(*values))


def holds(name: str, predicate: Column) -> RowCheck:
    """Rows for which the predicate is null pass."""
    return RowCheck(name, ~predicate)


def in_unit_interval(column: str) -> RowCheck:
    return RowCheck(
        f"unit_interval({column})", (F.col(column) < 0) | (F.col(column) > 1)
    )


def value_in_source(
    snippet: str = "source_snippet", number: str = "value_numeric", text: str = "value_text"
) -> RowCheck:
    failing = value_missing_from_source(F.col(snippet), F.col(number), F.col(text))
    return RowCheck("value_in_source", failing)


def unique(*columns: str) -> UniqueCheck:
    return UniqueCheck(f"unique({', '.join(columns)})", columns)


def has_parent(column: str, parent: DataFrame, parent_column: str) -> ParentCheck:
    return ParentCheck(f"relationships({column})", column, parent, parent_column)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows (or, for uniqueness, the repeated keys with their count) that fail."""
    if isinstance(check, RowCheck):
        return df.where(check.failing)
    if isinstance(check, UniqueCheck):
        rows = df if len(check.columns) > 1 else df.where(F.col(check.columns[0]).isNotNull())
        counted = rows.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("occurrences"))
        return counted.where("occurrences > 1")
    parents = check.parent.select(F.col(check.parent_column).alias("__parent")).distinct()
    children = df.where(F.col(check.column).isNotNull())
    return children.join(parents, F.col(check.column) == F.col("__parent"), "left_anti")


def summarize(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``check_name, failures, passed``.

    All row checks are counted in one pass over the table.
    """
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    parts: list[DataFrame] = []
    if row_checks:
        counts = df.agg(
            *[
                F.count_if(F.coalesce(c.failing, F.lit(False))).alias(f"c{i}")
                for i, c in enumerate(row_checks)
            ]
        )
        listed = F.array(
            *[
                F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("failures"))
                for i, c in enumerate(row_checks)
            ]
        )
        parts.append(counts.select(F.inline(listed)))
    for check in checks:
        if not isinstance(check, RowCheck):
            failures = F.count(F.lit(1)).alias("failures")
            parts.append(
                failing_rows(df, check)
                .agg(failures)
                .select(F.lit(check.name).alias("check_name"), "failures")
            )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)


def flagged_parent(column: str, flag: str) -> RowCheck:
    """Every key that is not null has a parent row, as the join that built the table has noted."""
    return RowCheck(f"relationships({column})", F.col(column).isNotNull() & ~F.col(flag))


def _entries(table: CheckedTable, first: int) -> list[Column]:
    """Per check (its number, a key, a mark) for rows that count, else null."""
    here = F.lit(True) if table.rows is None else F.coalesce(table.rows, F.lit(False))
    found = []
    for at, check in enumerate(table.checks, first):
        mark = F.lit(0)
        if isinstance(check, RowCheck):
            counts, key = F.coalesce(check.failing, F.lit(False)), F.lit(None).cast("string")
        elif isinstance(check, UniqueCheck) and len(check.columns) == 1:
            counts, key = F.col(check.columns[0]).isNotNull(), F.col(check.columns[0]).cast("string")
        elif isinstance(check, UniqueCheck):
            counts, key = F.lit(True), F.to_json(F.struct(*check.columns), {"ignoreNullFields": "false"})
        else:
            left, right = (F.when(side, bit).otherwise(0) for side, bit in ((check.left, 1), (check.right, 2)))
            counts, key, mark = check.left | check.right, F.col(check.column).cast("string"), left + right
        entry = F.struct(F.lit(at).alias("check"), key.alias("key"), mark.alias("mark"))
        found.append(F.when(here & counts, entry))
    return found


def fused_report(sources: Sequence[tuple[DataFrame, Sequence[CheckedTable]]]) -> DataFrame:
    """``table_name, check_name, failures, passed`` of all checks of all tables at once.

    A source is read once for all tables that are kinds of its rows. Its rows become (check, key)
    entries where they fail or where a key has to be looked at; entries of all sources meet in one
    aggregate per check and key, which combines before the shuffle, and one per check.
    """
    spark = sources[0][0].sparkSession
    names: list[tuple[str, str, str]] = []
    parts: list[DataFrame] = []
    for df, tables in sources:
        entries: list[Column] = []
        for table in tables:
            entries += _entries(table, len(names))
            names += [(table.name, check.name, type(check).__name__) for check in table.checks]
        parts.append(df.select(F.inline(F.array_compact(F.array(*entries)))))
    keys = reduce(DataFrame.unionByName, parts).groupBy("check", "key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("mark").alias("marks")
    )
    # as many rows as there are checks; those without an entry have no failures
    declared = spark.createDataFrame(
        [(at, *name) for at, name in enumerate(names)], "check int, table_name string, check_name string, kind string"
    )
    kinds = F.element_at(F.array(*[F.lit(kind) for *_, kind in names]), F.col("check") + 1)
    failing = (
        F.when(kinds == "RowCheck", F.col("n"))
        .when(kinds == "UniqueCheck", F.when(F.col("n") > 1, 1))
        .otherwise(F.when(F.col("marks") == 3, 1))
    )
    counted = keys.select("check", F.coalesce(failing, F.lit(0)).cast("long").alias("failures"))
    none = declared.select("check", F.lit(0).cast("long").alias("failures"))
    totals = counted.unionByName(none).groupBy("check").agg(F.sum("failures").alias("failures"))
    named = F.element_at(
        F.array(*[F.struct(F.lit(t).alias("t"), F.lit(c).alias("c")) for t, c, _ in names]), F.col("check") + 1
    )
    return totals.select(
        named["t"].alias("table_name"), named["c"].alias("check_name"), "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def common_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys found in both tables; two routes of one fact must share none."""
    return left.select(*keys).intersect(right.select(*keys).distinct())


# ---- the declared checks of the disclosure tables -----------------------------------


def raw_checks(topics, languages, models) -> list[Check]:
    columns = (
        "company_ticker", "fiscal_year", "esrs_topic", "esrs_disclosure", "confidence_score",
        "source_page", "source_snippet", "language", "extraction_model", "extraction_timestamp",
    )
    return [
        *[not_null(c) for c in columns],
        accepted_values("esrs_topic", topics),
        accepted_values("language", languages),
        accepted_values("extraction_model", models),
    ]


def staging_checks(models, natural_key) -> list[Check]:
    columns = (
        "company_ticker", "fiscal_year", "esrs_disclosure", "extraction_model",
        "confidence_score",
    )
    return [
        *[not_null(c) for c in columns],
        accepted_values("extraction_model", models),
        unique(*natural_key),
    ]


def company_checks(languages, countries) -> list[Check]:
    return [
        unique("company_id"), not_null("company_id"), unique("ticker"), not_null("ticker"),
        accepted_values("country", countries), accepted_values("language", languages),
    ]


def metric_checks(topics) -> list[Check]:
    return [
        unique("metric_id"), not_null("metric_id"), accepted_values("esrs_topic", topics),
        not_null("esrs_disclosure"),
    ]


def period_checks() -> list[Check]:
    return [
        unique("period_id"), not_null("period_id"), unique("fiscal_year"),
        not_null("fiscal_year"),
    ]


def fact_checks(company: str, metric: str, period: str) -> list[Check]:
    """Expects the flags of the joins that built the fact."""
    return [
        unique("disclosure_id"), not_null("disclosure_id"),
        not_null("company_id"), flagged_parent("company_id", company),
        not_null("metric_id"), flagged_parent("metric_id", metric),
        not_null("period_id"), flagged_parent("period_id", period),
        not_null("confidence_score"),
        holds("score_range", F.col("confidence_score").between(0, 1)),
        not_null("source_snippet"),
        in_unit_interval("confidence_score"),
        value_in_source(),
    ]


def published_checks(threshold: Column) -> list[Check]:
    """Expects the reviewers' ``human_approved`` next to the mart's columns."""
    return [
        unique("disclosure_id"), not_null("disclosure_id"),
        holds(
            "published_rule",
            (F.col("confidence_score") >= threshold) | F.coalesce("human_approved", F.lit(False)),
        ),
    ]


def review_checks() -> list[Check]:
    return [
        unique("disclosure_id"), not_null("disclosure_id"),
        RowCheck("accepted_values(human_approved)", F.coalesce("human_approved", F.lit(False))),
    ]


def seed_expectations(
    df: DataFrame, name: str, rows: int, columns: Sequence[str], checks: Sequence[Check]
) -> DataFrame:
    """Expectations of a reference list: row count, column set, and its checks."""
    counted = df.agg(F.abs(F.count(F.lit(1)) - rows).alias("failures"))
    count_row = counted.select(F.lit(f"row_count({name})").alias("check_name"), "failures")
    differing = len(set(df.columns) ^ set(columns))
    column_row = counted.select(
        F.lit(f"columns({name})").alias("check_name"),
        F.lit(differing).cast("long").alias("failures"),
    )
    both = count_row.unionByName(column_row).withColumn("passed", F.col("failures") == 0)
    return both.unionByName(summarize(df, checks)) if checks else both
