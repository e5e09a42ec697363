"""The disclosure pipeline from pages to reports, as a few lazy plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.fixed_values import (
    CONFIDENCE_THRESHOLD,
    DEFAULT_FISCAL_YEAR,
    LANGUAGES,
    MAX_PAGES,
    MAX_PROMPT_CHARS,
    MODELS,
    NATURAL_KEY,
    TOPIC_KEYWORDS,
    TOPICS,
)
from tracebook.operators import quality, star
from tracebook.operators.joins import work_list
from tracebook.operators.pages import page_rows, prompt_rows, topic_excerpts
from tracebook.operators.payloads import attempt_outcomes, judged_attempts, scored_records
from tracebook.operators.picks import latest_per_key
from tracebook.schemas import COMPANIES, MARTS, METRICS, PERIODS, RAW, SCORE_TYPE
from tracebook.session import checkpointed
from tracebook.sources.sinks import as_table, new_version, switch_version, version_table

#: what a refresh stores: staging and the marts
STORED = {"stg_disclosure": RAW, **MARTS}


def prompts(
    pages: DataFrame,
    companies: DataFrame,
    fiscal_year: int = DEFAULT_FISCAL_YEAR,
    max_pages: int = MAX_PAGES,
    max_chars: int = MAX_PROMPT_CHARS,
) -> DataFrame:
    """Report pages to one prompt per (report, topic)."""
    excerpts = topic_excerpts(page_rows(pages, max_pages), TOPIC_KEYWORDS, max_chars)
    return prompt_rows(excerpts, companies, fiscal_year)


@dataclass(frozen=True)
class Extraction:
    """Outcome per work item, the landing rows, and rows that broke a record rule."""

    outcomes: DataFrame
    rows: DataFrame
    rejected: DataFrame


def extraction(
    payloads: DataFrame,
    companies: DataFrame,
    fiscal_year: int = DEFAULT_FISCAL_YEAR,
    extracted_at: Column | None = None,
) -> Extraction:
    """Model answers to scored landing rows.

    ``companies`` has ``report_id, ticker, name, language``. Every (report, topic) has an
    outcome; it failed if neither model gave an acceptable payload.
    """
    work = work_list(companies.select("report_id"), TOPICS)
    outcomes = attempt_outcomes(work, judged_attempts(payloads))
    chosen = outcomes.where(F.col("error").isNull())
    rows, rejected = scored_records(chosen, companies, fiscal_year, extracted_at)
    return Extraction(outcomes, rows, rejected)


@dataclass(frozen=True)
class Warehouse:
    """Staging, dimensions, fact and marts of one build; ``joined`` is staging with its parents."""

    staged: DataFrame
    companies: DataFrame
    metrics: DataFrame
    periods: DataFrame
    joined: DataFrame
    wide: DataFrame
    fact: DataFrame
    published: DataFrame
    review: DataFrame


def build(
    raw: DataFrame,
    companies: DataFrame,
    catalogue: DataFrame,
    periods: DataFrame,
    approvals: DataFrame | None = None,
    threshold: float = CONFIDENCE_THRESHOLD,
    rejected_wins: bool = False,
    listed: str = "value",
) -> Warehouse:
    """Raw rows and reference lists to star schema and routed marts, as lazy plans.

    A mart reads raw once: the metric dimension is derived from staging but not joined back.
    """
    staged = latest_per_key(raw)
    company = star.company_dimension(companies)
    period = star.period_dimension(periods)
    joined = star.joined_fact(staged, company, catalogue, period, approvals, listed)
    wide = star.wide_fact(joined)
    options = {"rejected_wins": rejected_wins}
    return Warehouse(
        staged=staged,
        companies=company,
        metrics=star.metric_dimension(catalogue, staged),
        periods=period,
        joined=joined,
        wide=wide,
        fact=star.fact(wide),
        published=star.published_mart(wide, threshold, **options),
        review=star.review_mart(wide, threshold, **options),
    )


def refresh(
    raw: DataFrame,
    companies: DataFrame,
    catalogue: DataFrame,
    periods: DataFrame,
    database: str,
    approvals: DataFrame | None = None,
    threshold: float = CONFIDENCE_THRESHOLD,
    rejected_wins: bool = False,
) -> Warehouse:
    """Full refresh: a new version of every table beside the old ones, then all views switched.

    Readers use the views ``database.stg_disclosure``, ``dim_*``, ``fact_disclosure`` and
    ``mart_*``. They show the version before until every table of the new one is written, so a
    refresh that fails leaves them as they were; it can be run again.

    Staging feeds the metric dimension and the fact, the joined rows feed fact and marts; both
    are stored before they are used again, so nothing above them is computed twice.
    """
    spark = raw.sparkSession
    version = new_version()

    def store(df: DataFrame, name: str) -> DataFrame:
        return as_table(df, version_table(database, name, version), STORED[name])

    latest = latest_per_key(raw)
    latest.createOrReplaceTempView("stg_disclosure")  # over raw: shows rows that come later
    staged = store(latest, "stg_disclosure")
    company = store(star.company_dimension(companies), "dim_company")
    metric = store(star.metric_dimension(catalogue, staged), "dim_metric")
    period = store(star.period_dimension(periods), "dim_period")
    joined = checkpointed(star.joined_fact(staged, company, catalogue, period, approvals))
    wide = star.wide_fact(joined)
    options = {"rejected_wins": rejected_wins}
    warehouse = Warehouse(
        staged=staged,
        companies=company,
        metrics=metric,
        periods=period,
        joined=joined,
        wide=wide,
        fact=store(star.fact(wide), "fact_disclosure"),
        published=store(star.published_mart(wide, threshold, **options), "mart_disclosure_published"),
        review=store(star.review_mart(wide, threshold, **options), "mart_disclosure_review_queue"),
    )
    switch_version(spark, database, tuple(STORED), version)
    return warehouse


def seed_report(
    companies: DataFrame,
    catalogue: DataFrame,
    periods: DataFrame,
    rows: tuple[int, int, int] = (10, 19, 1),
) -> DataFrame:
    """Expectations of the three reference lists as shipped: sizes, columns, values, keys."""
    expectations = [
        (
            companies,
            "companies",
            rows[0],
            COMPANIES,
            [quality.unique("ticker"), quality.accepted_values("language", LANGUAGES)],
        ),
        (
            catalogue,
            "metrics",
            rows[1],
            METRICS,
            [
                quality.accepted_values("esrs_topic", TOPICS),
                quality.unique("esrs_disclosure", "metric_name"),
            ],
        ),
        (periods, "periods", rows[2], PERIODS, [quality.unique("fiscal_year")]),
    ]
    parts = [
        quality.seed_expectations(df, name, size, schema.fieldNames(), checks)
        for df, name, size, schema, checks in expectations
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run_checks(
    warehouse: Warehouse,
    raw: DataFrame,
    countries: tuple[str, ...],
    threshold: float = CONFIDENCE_THRESHOLD,
    rejected_wins: bool = False,
) -> DataFrame:
    """All declared checks: ``table_name, check_name, failures, passed``, in one lazy plan.

    Staging, the fact and both marts are kinds of the joined rows and are judged in one pass over
    them; parents are what their joins have found, routes are the conditions of the marts.
    """
    limit = F.lit(str(threshold)).cast(SCORE_TYPE)
    score, approved = F.col("confidence_score"), F.col("human_approved")
    whole = star.has_parents()
    published = whole & star.is_published(score, approved, threshold, rejected_wins)
    review = whole & star.is_for_review(score, approved, threshold, rejected_wins)
    disjoint = quality.DisjointCheck("routes_disjoint", "disclosure_id", published, review)
    of_joined = [
        quality.CheckedTable("staging", quality.staging_checks(MODELS, NATURAL_KEY)),
        quality.CheckedTable("fact", quality.fact_checks(star.HAS_COMPANY, star.HAS_METRIC, star.HAS_PERIOD), whole),
        quality.CheckedTable("published", quality.published_checks(limit), published),
        quality.CheckedTable("review", quality.review_checks(), review),
        quality.CheckedTable("marts", [disjoint]),
    ]
    dimensions = [
        (warehouse.companies, quality.CheckedTable("dim_company", quality.company_checks(LANGUAGES, countries))),
        (warehouse.metrics, quality.CheckedTable("dim_metric", quality.metric_checks(TOPICS))),
        (warehouse.periods, quality.CheckedTable("dim_period", quality.period_checks())),
    ]
    return quality.fused_report(
        [
            (raw, [quality.CheckedTable("raw", quality.raw_checks(TOPICS, LANGUAGES, MODELS))]),
            *[(df, [table]) for df, table in dimensions],
            (warehouse.joined, of_joined),
        ]
    )
