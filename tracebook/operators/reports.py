"""Summaries, company profiles and portfolio reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.fixed_values import CONFIDENCE_THRESHOLD, EXPORT_ORDER, TOPICS
from tracebook.functions.scoring import band
from tracebook.operators.joins import left_with_default, work_list
from tracebook.operators.picks import preferred_first

# ---- routing and attempts -----------------------------------------------------------


def _whole_percent(part: Column, total: Column) -> Column:
    """Whole percentage, half to even, 0 for an empty total."""
    return F.bround(part * 100 / F.greatest(total, F.lit(1)), 0).cast("long")


def route_summary(
    df: DataFrame, score: str = "confidence_score", threshold: float = CONFIDENCE_THRESHOLD
) -> DataFrame:
    """One row: total, published, review, and their whole percentages."""
    published = F.count_if(band(F.col(score), threshold) == "published")
    counted = df.agg(F.count(F.lit(1)).alias("total"), published.alias("published"))
    split = counted.withColumn("review", F.col("total") - F.col("published"))
    return split.withColumns(
        {
            "published_pct": _whole_percent(F.col("published"), F.col("total")),
            "review_pct": _whole_percent(F.col("review"), F.col("total")),
        }
    )


def attempt_matrix(
    entities: DataFrame,
    items: Sequence[object],
    results: DataFrame,
    entity: str,
    item: str,
    error: Column | None = None,
) -> DataFrame:
    """Status and result count of every (entity, item) attempt, empty attempts included.

    Results are counted before they meet the work list.
    """
    message = F.max(error) if error is not None else F.lit(None).cast("string")
    counted = results.groupBy(entity, item).agg(
        F.count(F.lit(1)).alias("result_count"), message.alias("error")
    )
    work = work_list(entities.select(entity), items, item)
    joined = work.join(counted, [entity, item], "left")
    return joined.select(
        entity,
        item,
        F.when(F.col("error").isNull(), F.coalesce("result_count", F.lit(0)))
        .otherwise(0)
        .cast("long")
        .alias("result_count"),
        F.when(F.col("error").isNull(), "ok").otherwise("ERR").alias("status"),
        "error",
    )


def failure_gate(attempts: DataFrame, failed: Column) -> DataFrame:
    """One row: attempts, failed attempts, and whether more than half of them failed."""
    counted = attempts.agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.coalesce(failed, F.lit(False))).alias("failed"),
    )
    return counted.withColumn("gate_broken", F.col("failed") > F.floor(F.col("attempts") / 2))


def attempt_ledger(outcomes: DataFrame) -> DataFrame:
    """Counts of work items by topic, model and error; per topic; and over all, in one rollup.

    ``level`` is 0 for a (topic, model, error), 1 for a topic and 3 for everything. The gate of
    a row is broken if more than half of its work items failed. A failed item has no model.
    """
    ended = outcomes.select(
        "topic", F.struct("model", "error").alias("ended"), F.col("error").isNotNull().alias("failure")
    )
    counted = ended.rollup("topic", "ended").agg(
        F.grouping_id().cast("int").alias("level"),
        F.count(F.lit(1)).alias("attempts"),
        F.count_if("failure").alias("failed"),
    )
    return counted.select(
        "level",
        "topic",
        F.col("ended.model").alias("model"),
        F.col("ended.error").alias("error"),
        "attempts",
        "failed",
        (F.col("failed") > F.floor(F.col("attempts") / 2)).alias("gate_broken"),
    )


def count_by(df: DataFrame, column: str, name: str = "row_count") -> DataFrame:
    """Rows per value, ordered by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(column)


def row_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows in total (null key) and per value, total first."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    total = per_value.agg(
        F.lit(None).cast(df.schema[column].dataType).alias(column),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
    )
    return total.unionByName(per_value).orderBy(F.col(column).asc_nulls_first())


def mean_score(entities: DataFrame, facts: DataFrame, on: str, score: str) -> DataFrame:
    """Mean score per entity, 0 for an entity without facts."""
    mean = F.sum(score).cast("double") / F.count(score)
    means = facts.groupBy(on).agg(mean.alias("mean_score"))
    return left_with_default(entities.select(on), means, on, "mean_score", 0.0)


# ---- profiles -----------------------------------------------------------------------


def topic_profile(
    df: DataFrame,
    entity: str,
    topic: str,
    score: str,
    topics: Sequence[str] = TOPICS,
    threshold: float = CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """Counts per entity and topic with the topic's place in the canonical order.

    Topics outside the canonical list are left out; empty topics have no row.
    """
    place = F.array_position(F.array(*[F.lit(t) for t in topics]), F.col(topic))
    published = F.count_if(band(F.col(score), threshold) == "published")
    profile = (
        df.where(F.col(topic).isin(*topics))
        .groupBy(entity, topic)
        .agg(F.count(F.lit(1)).alias("total"), published.alias("published"))
    )
    return profile.select(
        entity,
        topic,
        place.alias("topic_position"),
        "total",
        "published",
        (F.col("total") - F.col("published")).alias("review"),
    )


def coverage(entities: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """One row: entities with at least one fact, and all entities."""
    marked = entities.select(on).join(
        facts.select(on).distinct().withColumn("__found", F.lit(1)), on, "left"
    )
    return marked.agg(
        F.count("__found").alias("covered"), F.count(F.lit(1)).alias("entities")
    )


def export_rows(staged: DataFrame) -> DataFrame:
    """Rows in the export order (a global sort; for exports only)."""
    return staged.orderBy(*EXPORT_ORDER)


# ---- portfolio ----------------------------------------------------------------------


def is_scope_1() -> Column:
    return (
        (F.col("esrs_disclosure") == "E1-6")
        & F.contains(F.lower("metric_name"), F.lit("scope 1"))
        & F.col("value_numeric").isNotNull()
    )


def scope_1_rows(staged: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Per company the Scope 1 row to report: the first good one, else the first one."""
    eligible = band(F.col("confidence_score"), threshold) == "published"
    order = [F.col(c).asc() for c in EXPORT_ORDER[1:]]
    return preferred_first(staged.where(is_scope_1()), ["company_ticker"], eligible, order)


def rounded_ratio(amount: Column, base: Column) -> Column:
    """Nearest whole ratio, halves up; null without amount or with a base of 0 or less."""
    ratio = amount.cast("double") / base.cast("double")
    return F.when(base > 0, F.floor(ratio + 0.5)).cast("long")


def portfolio_exposures(
    companies: DataFrame, exposures: DataFrame, scope_1: DataFrame
) -> DataFrame:
    """Every company with its exposure (0 if unknown), Scope 1 amount and intensity."""
    exposed = left_with_default(companies, exposures, "ticker", "exposure_eur_m", 0)
    amounts = scope_1.select(
        F.col("company_ticker").alias("ticker"), F.col("value_numeric").alias("scope_1")
    )
    joined = exposed.join(amounts, "ticker", "left")
    return joined.withColumn(
        "intensity", rounded_ratio(F.col("scope_1"), F.col("exposure_eur_m"))
    )


def portfolio_totals(
    exposures: DataFrame, exposure: str = "exposure_eur_m", amount: str = "scope_1"
) -> DataFrame:
    """One row: total exposure, total amount, rounded ratio (0 guard), companies covered."""
    summed = exposures.agg(
        F.coalesce(F.sum(exposure), F.lit(0)).alias("total_exposure"),
        F.coalesce(F.sum(amount), F.lit(0)).alias("total_amount"),
        F.count(amount).alias("covered"),
    )
    ratio = rounded_ratio(F.col("total_amount"), F.col("total_exposure"))
    return summed.withColumn("intensity", F.coalesce(ratio, F.lit(0)))
