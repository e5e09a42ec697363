"""Star schema: dimensions, self-extending dimension, fact, and the two routed marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.fixed_values import CONFIDENCE_THRESHOLD, NATURAL_KEY
from tracebook.functions.keys import surrogate_key
from tracebook.schemas import SCORE_TYPE


@dataclass(frozen=True)
class Dimension:
    """A dimension table and how the fact reaches it.

    ``on`` maps fact columns to the dimension's natural key columns; ``key`` is the
    surrogate key column.
    """

    table: DataFrame
    key: str
    on: Mapping[str, str]


def keyed(df: DataFrame, key: str, natural: Sequence[str]) -> DataFrame:
    """Put the surrogate key in front of a natural table."""
    return df.select(surrogate_key(*natural).alias(key), "*")


def extend_dimension(
    catalogue: DataFrame,
    observed: DataFrame,
    natural: Sequence[str],
    attributes: Sequence[str],
    flag: str = "is_in_catalog",
) -> DataFrame:
    """Catalogue rows plus one row per natural key seen in the data only.

    A discovered key with several attribute values keeps the smallest row of attributes,
    so that the surrogate key stays unique; ``attribute_conflicts`` lists such keys.
    """
    listed = catalogue.select(*natural, *attributes, F.lit(True).alias(flag))
    # the smallest attributes are kept per key on the map side: one row per key and task is shuffled
    chosen = observed.groupBy(*natural).agg(F.min(F.struct(*attributes)).alias("__chosen"))
    unknown = chosen.join(catalogue.select(*natural), list(natural), "left_anti")
    discovered = unknown.select(
        *natural,
        *[F.col(f"__chosen.{a}").alias(a) for a in attributes],
        F.lit(False).alias(flag),
    )
    return listed.unionByName(discovered)


def attribute_conflicts(
    observed: DataFrame, natural: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Natural keys observed with more than one combination of attributes."""
    combinations = observed.select(*natural, *attributes).distinct()
    counted = combinations.groupBy(*natural).agg(F.count(F.lit(1)).alias("variants"))
    return counted.where("variants > 1")


def metric_dimension(catalogue: DataFrame, staged: DataFrame) -> DataFrame:
    """Disclosure metrics: catalogue plus discovered, with surrogate key and flags."""
    natural = ["esrs_disclosure", "metric_name"]
    merged = extend_dimension(catalogue, staged, natural, ["esrs_topic", "unit"])
    return merged.select(
        surrogate_key(*natural).alias("metric_id"),
        "esrs_topic",
        *natural,
        "unit",
        F.col("is_in_catalog").alias("mandatory_flag"),
        "is_in_catalog",
    )


def join_dimensions(
    fact: DataFrame, dimensions: Sequence[Dimension], flags: Sequence[str] = ()
) -> DataFrame:
    """Inner joins on natural keys; rows without a match drop out.

    All other dimension columns are carried along, so that fact and marts are projections of
    one wide table and nothing is joined twice. Where names meet, the earlier column stays.
    With ``flags``, one name per dimension, rows without a match stay and say so there.
    """
    wide = fact
    for number, dimension in enumerate(dimensions):
        taken = set(wide.columns)
        renamed = {natural: f"__d{number}_{natural}" for natural in dimension.on.values()}
        carried = [c for c in dimension.table.columns if c not in taken]
        found = [F.lit(True).alias(flags[number])] if flags else []
        side = dimension.table.select(
            *[F.col(c).alias(alias) for c, alias in renamed.items()], *carried, *found
        )
        condition = reduce(
            lambda a, b: a & b,
            [F.col(f) == F.col(renamed[natural]) for f, natural in dimension.on.items()],
        )
        wide = wide.join(side, condition, "left" if flags else "inner").drop(*renamed.values())
    return wide.withColumns({flag: F.coalesce(flag, F.lit(False)) for flag in flags})


def join_on_surrogates(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Mart denormalisation from stored tables: inner joins on surrogate keys."""
    wide = fact
    for dimension in dimensions:
        taken = set(wide.columns) - {dimension.key}
        side = dimension.table.select(*[c for c in dimension.table.columns if c not in taken])
        wide = wide.join(side, dimension.key, "inner")
    return wide


# ---- disclosure star ---------------------------------------------------------------

FACT_COLUMNS = (
    "disclosure_id",
    "company_id",
    "metric_id",
    "period_id",
    "value_numeric",
    "value_text",
    "unit",
    "confidence_score",
    "source_page",
    "source_snippet",
    "language",
    "extraction_model",
    "extraction_timestamp",
    "human_approved",
)
MART_COLUMNS = (
    "disclosure_id",
    "company_ticker",
    "company_name",
    "sector",
    "country",
    "esrs_topic",
    "esrs_disclosure",
    "metric_name",
    "fiscal_year",
    "value_numeric",
    "value_text",
    "unit",
    "confidence_score",
    "source_page",
    "source_snippet",
    "language",
    "extraction_model",
    "extraction_timestamp",
)


def company_dimension(companies: DataFrame) -> DataFrame:
    return keyed(companies, "company_id", ["ticker"])


def period_dimension(periods: DataFrame) -> DataFrame:
    return keyed(periods, "period_id", ["fiscal_year"])


HAS_COMPANY, HAS_METRIC, HAS_PERIOD = "has_company", "has_metric", "has_period"
LISTED_METRICS = 5_000


def listed_topic(catalogue: DataFrame, bound: int = LISTED_METRICS) -> Column:
    """The topic of a row's metric in the catalogue, null if it is not listed there.

    The catalogue is a reference list: it reaches the rows as one value, a map of maps, instead of
    a join that would move every row. More than ``bound`` metrics raise; join those.
    """
    natural = ["esrs_disclosure", "metric_name"]
    listed = catalogue.dropna(subset=natural).groupBy(*natural).agg(F.min("esrs_topic").alias("topic"))
    by_code = listed.limit(bound + 1).groupBy("esrs_disclosure").agg(
        F.map_from_entries(F.collect_list(F.struct("metric_name", "topic"))).alias("topics")
    )
    both = F.map_from_entries(F.collect_list(F.struct("esrs_disclosure", "topics")))
    refused = F.raise_error(F.lit(f"more than {bound} listed metrics: build with listed='join'"))
    one = by_code.agg(both.alias("codes"), F.sum(F.size("topics")).alias("n")).select(
        F.when(F.col("n") > bound, refused).otherwise(F.col("codes"))
    )
    return F.try_element_at(F.try_element_at(one.scalar(), F.col("esrs_disclosure")), F.col("metric_name"))


def joined_fact(
    staged: DataFrame,
    companies: DataFrame,
    catalogue: DataFrame,
    periods: DataFrame,
    approvals: DataFrame | None = None,
    listed: str = "value",
) -> DataFrame:
    """Every staged record with dimension attributes, surrogate keys and whether it has parents.

    ``companies`` and ``periods`` are keyed dimensions. The metric dimension is made of the
    catalogue and of these very rows, so it is not joined back: a row's metric key is the hash of
    its own columns, and it has a metric if it names one. The topic is that of the catalogue, or
    the row's own for a metric that is not listed. Without an approvals table (``disclosure_id,
    human_approved``) nothing is reviewed yet and the flag is null. ``listed`` = "join" looks the
    catalogue up by a join, for lists too long for a value.
    """
    company = companies.select(
        "company_id", "ticker", F.col("name").alias("company_name"), "sector", "country"
    )
    natural = ["esrs_disclosure", "metric_name"]
    named = F.col("esrs_disclosure").isNotNull() & F.col("metric_name").isNotNull()
    identified = staged.withColumns(
        {
            "disclosure_id": surrogate_key(*NATURAL_KEY),
            "metric_id": F.when(named, surrogate_key(*natural)),
            HAS_METRIC: named,
        }
    )
    wide = join_dimensions(
        identified,
        [
            Dimension(company, "company_id", {"company_ticker": "ticker"}),
            Dimension(periods.select("period_id", "fiscal_year"), "period_id", {"fiscal_year": "fiscal_year"}),
        ],
        [HAS_COMPANY, HAS_PERIOD],
    )
    if listed == "join":
        topics = catalogue.groupBy(*natural).agg(F.min("esrs_topic").alias("__listed"))
        wide = wide.join(topics, natural, "left")
        wide = wide.withColumn("esrs_topic", F.coalesce("__listed", "esrs_topic")).drop("__listed")
    else:
        wide = wide.withColumn("esrs_topic", F.coalesce(listed_topic(catalogue), F.col("esrs_topic")))
    if approvals is None:
        return wide.withColumn("human_approved", F.lit(None).cast("boolean"))
    return wide.join(latest_decisions(approvals), "disclosure_id", "left")


def has_parents() -> Column:
    return F.col(HAS_COMPANY) & F.col(HAS_METRIC) & F.col(HAS_PERIOD)


def wide_fact(joined: DataFrame) -> DataFrame:
    """The rows of ``joined_fact`` that have a company, a metric and a period."""
    return joined.where(has_parents()).drop(HAS_COMPANY, HAS_METRIC, HAS_PERIOD)


def latest_decisions(approvals: DataFrame) -> DataFrame:
    """One decision per disclosure: the latest where times are kept, and a rejection among equals."""
    when = F.col("decided_at") if "decided_at" in approvals.columns else F.lit(0)
    return approvals.groupBy("disclosure_id").agg(
        F.max_by("human_approved", F.struct(when, ~F.col("human_approved"))).alias("human_approved")
    )


def fact(wide: DataFrame) -> DataFrame:
    return wide.select(*FACT_COLUMNS)


# ---- routing -----------------------------------------------------------------------


def _threshold(threshold: float) -> Column:
    return F.lit(str(threshold)).cast(SCORE_TYPE)


def is_published(
    score: Column,
    approved: Column,
    threshold: float = CONFIDENCE_THRESHOLD,
    rejected_wins: bool = False,
) -> Column:
    """Publish a row whose score reaches the threshold or that a reviewer approved.

    By default a high score is published even after a rejection. ``rejected_wins`` keeps a
    rejected row out instead.
    """
    by_score = score >= _threshold(threshold)
    if rejected_wins:
        by_score = by_score & F.coalesce(approved, F.lit(True))
    return by_score | F.coalesce(approved, F.lit(False))


def is_for_review(
    score: Column,
    approved: Column,
    threshold: float = CONFIDENCE_THRESHOLD,
    rejected_wins: bool = False,
) -> Column:
    """The rows with a score that ``is_published`` leaves out."""
    waiting = (score < _threshold(threshold)) & ~F.coalesce(approved, F.lit(False))
    if rejected_wins:
        waiting = waiting | (score.isNotNull() & (approved == F.lit(False)))
    return waiting


def published_mart(wide: DataFrame, threshold: float = CONFIDENCE_THRESHOLD, **options) -> DataFrame:
    keep = is_published(F.col("confidence_score"), F.col("human_approved"), threshold, **options)
    return wide.where(keep).select(*MART_COLUMNS)


def review_mart(wide: DataFrame, threshold: float = CONFIDENCE_THRESHOLD, **options) -> DataFrame:
    keep = is_for_review(F.col("confidence_score"), F.col("human_approved"), threshold, **options)
    approved = F.coalesce(F.col("human_approved"), F.lit(False)).alias("human_approved")
    return wide.where(keep).select(*MART_COLUMNS, approved)
