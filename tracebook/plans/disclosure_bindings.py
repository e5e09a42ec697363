"""The disclosure pipeline itself over records that Spark derives from the test tables.

Events become landing rows, nested records and model payloads; customers are the companies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracebook.fixed_values import NATURAL_KEY
from tracebook.functions import rules
from tracebook.functions.keys import file_key, surrogate_key
from tracebook.operators import joins, reports
from tracebook.operators.snapshot import disclosure_documents
from tracebook.plans import disclosures
from tracebook.plans.bindings import query, score_of, stamp
from tracebook.plans.tables import table
from tracebook.schemas import METRICS, PERIODS, RAW
from tracebook.sources.scans import landing_rows

TOPIC_OF = {"click": "E1", "view": "E2", "purchase": "E3", "error": "S1", "signup": "G1"}
FIRST_MODEL, SECOND_MODEL = "claude-sonnet-4-6", "mistral-large-latest"


def _topic() -> Column:
    pairs = [F.lit(part) for pair in TOPIC_OF.items() for part in pair]
    return F.element_at(F.create_map(*pairs), F.col("event_type"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns of a disclosure record next to their own."""
    events = table(spark, sf_dir, "events")
    rank = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    return events.withColumn("k", rank).select(
        "*",
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("company_ticker"),
        F.when(F.col("event_type") == "signup", 2023).otherwise(2024).alias("fiscal_year"),
        _topic().alias("esrs_topic"),
        F.concat(_topic(), F.lit("-"), (F.floor(F.col("k") / 40) + 1).cast("string")).alias(
            "esrs_disclosure"
        ),
        F.concat(F.lit("Metric "), F.floor(F.col("k") / 10).cast("string")).alias("metric_name"),
        F.lit(None).cast("string").alias("value_text"),
        F.lit("u").alias("unit"),
        score_of(F.least(F.col("value"), F.lit(100.0)) / 100).alias("confidence_score"),
        (F.col("k") + 1).alias("source_page"),
        F.concat(F.lit("Props reported: "), F.col("props")).alias("source_snippet"),
        F.lit("en").alias("language"),
        F.when(F.col("value") < 40, FIRST_MODEL).otherwise(SECOND_MODEL).alias("extraction_model"),
        F.col("ts").cast("timestamp").alias("extraction_timestamp"),
        F.col("value").alias("value_numeric"),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir)
    return records.select(*[F.col(f.name).cast(f.dataType) for f in RAW.fields])


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("sector"),
        F.lit("FR").alias("country"),
        F.concat(F.lit("https://c.example/"), F.col("c_name")).alias("ir_page_url"),
        F.lit("en").alias("language"),
    )


def reference_lists(spark: SparkSession, sf_dir: str, raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Companies, a catalogue of the metrics with a high value, and the years of one topic."""
    catalogue = raw.where("value_numeric > 200").select(*METRICS.fieldNames()).distinct()
    years = raw.where("esrs_topic = 'E1'").select("fiscal_year").distinct()
    periods = years.select(
        "fiscal_year",
        F.make_date("fiscal_year", F.lit(1), F.lit(1)).alias("period_start"),
        F.make_date("fiscal_year", F.lit(12), F.lit(31)).alias("period_end"),
        F.lit("year").alias("reporting_basis"),
    ).to(PERIODS)
    return companies(spark, sf_dir), catalogue, periods


def build(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, disclosures.Warehouse]:
    """Raw rows and the star built on them."""
    raw = raw_rows(spark, sf_dir)
    return raw, disclosures.build(raw, *reference_lists(spark, sf_dir, raw))


def _plain(mart: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text, for comparison."""
    return mart.withColumns(
        {
            "value_numeric": F.col("value_numeric").cast("double"),
            "confidence_score": F.col("confidence_score").cast("double"),
            "fiscal_year": F.col("fiscal_year").cast("int"),
            "extraction_timestamp": stamp("extraction_timestamp"),
        }
    )


@query
def disclosures_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(build(spark, sf_dir)[1].published).drop("value_text")


@query
def disclosures_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(build(spark, sf_dir)[1].review).drop("value_text")


@query
def disclosures_reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both routes after reviewers have decided on a third of the records, some of them twice.

    Views have words for values; a rejected record waits whatever its score.
    """
    word = F.when(F.col("esrs_topic") == "E2", F.concat(F.lit("Word "), F.col("source_page").cast("string")))
    raw = raw_rows(spark, sf_dir).withColumn("value_text", word)
    decisions = raw.where("source_page % 3 = 0").select(
        surrogate_key(*NATURAL_KEY).alias("disclosure_id"),
        (F.col("source_page") % 2 == 0).alias("human_approved"),
        F.col("extraction_timestamp").alias("decided_at"),
    )
    lists = reference_lists(spark, sf_dir, raw)
    house = disclosures.build(raw, *lists, approvals=decisions, rejected_wins=True)
    published = house.published.withColumns({"human_approved": F.lit(None).cast("boolean"), "route": F.lit("published")})
    return _plain(published.unionByName(house.review.withColumn("route", F.lit("review"))))


@query
def disclosure_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir)[1].metrics


@query
def disclosure_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, house = build(spark, sf_dir)
    return disclosures.run_checks(house, raw, ("FR",))


@query
def disclosure_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure_documents(raw_rows(spark, sf_dir), 2024)


@query
def snapshot_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of at most five items: companies go on in further parts."""
    return disclosure_documents(raw_rows(spark, sf_dir), 2024, part_size=5)


@query
def flattened_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records flattened and judged by the record rules."""
    events = event_records(spark, sf_dir)
    word = F.when(F.col("event_type").isin("view", "error"), F.lit("Yes"))
    odd_score = F.when(F.col("event_id") % 10 == 3, 1.0004).when(F.col("event_id") % 10 == 4, 12.0)
    odd_value = F.when(F.col("event_id") % 10 == 5, 1e22).when(F.col("event_id") % 10 == 6, 1e30)
    nested = events.withColumns(
        {
            "confidence_score": F.coalesce(odd_score, F.col("confidence_score").cast("double")),
            "value_numeric": F.when(
                F.col("event_type") != "view", F.coalesce(odd_value, F.col("value_numeric").cast("double"))
            ),
            "value_text": word,
            "source_citation": F.struct(
                (F.col("source_page") - 5).alias("page"),
                F.when(F.col("k") < 90, F.col("source_snippet")).alias("snippet"),
            ),
            "unit": F.col("event_id").cast("string"),
        }
    ).drop("source_page", "source_snippet", "ts")
    valid, invalid = landing_rows(nested)
    both = valid.withColumn("violations", F.array().cast("array<string>")).unionByName(invalid)
    return both.select(
        F.col("unit").cast("long").alias("event_id"),
        "company_ticker",
        "source_page",
        F.coalesce("value_numeric", F.lit(-1)).cast("double").alias("value_numeric"),
        F.array_join("violations", ",").alias("violations"),
    )


def model_answers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two model answers per event, and the events as reports.

    The first answer is cut short for clicks; the second has a page of 0 where k is 80 or
    more.
    """
    events = event_records(spark, sf_dir)
    attempts = events.select(
        "*",
        F.posexplode(F.array(F.lit(FIRST_MODEL), F.lit(SECOND_MODEL))).alias("priority", "model"),
    )
    first = F.col("priority") == 0
    rank = F.col("k").cast("string")
    payload = F.concat(
        F.lit('{"metrics": [{"esrs_disclosure": "'), F.col("esrs_disclosure"),
        F.lit('.part", "metric_name": "'), F.col("metric_name"),
        F.lit('", "value_numeric": '), F.when(first, rank).otherwise(F.col("value").cast("string")),
        F.lit(', "unit": null, "model_confidence": '), (F.col("k") / 100).cast("string"),
        F.lit(', "source_page": '), F.when(~first & (F.col("k") >= 80), "0").otherwise('"7"'),
        F.lit(', "source_snippet": "Props reported in the text: '), rank, F.lit('"}]'),
        F.when(first & (F.col("event_type") == "click"), "").otherwise("}"),
    )
    payloads = attempts.select(
        F.col("event_id").alias("report_id"),
        F.col("esrs_topic").alias("topic"),
        "model",
        "priority",
        payload.alias("payload"),
        F.lit(None).cast("string").alias("error"),
    )
    reports = events.select(
        F.col("event_id").alias("report_id"),
        F.concat(F.lit("EV"), F.col("event_id").cast("string")).alias("ticker"),
        F.lit("name").alias("name"),
        "language",
    )
    return payloads, reports


@query
def attempt_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of every (event, topic) by model and messages, per topic and in all, with the gate."""
    return reports.attempt_ledger(disclosures.extraction(*model_answers(spark, sf_dir), 2024).outcomes)


@query
def extracted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two model answers per event through acceptance, fallback, stamping and scoring."""
    extracted_at = F.lit("2024-06-01").cast("timestamp")
    rows = disclosures.extraction(*model_answers(spark, sf_dir), 2024, extracted_at).rows
    return rows.select(
        "company_ticker", "esrs_topic", "esrs_disclosure", "metric_name", "source_page",
        "extraction_model", F.col("value_numeric").cast("double"),
        F.col("confidence_score").cast("double"),
    )


@query
def resolved_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a secure address resolve to it; the others are reported."""
    registry = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("ticker"),
        F.when(F.startswith("url", F.lit("https://")), F.col("url")).alias("known_report_url"),
    )
    resolved, unresolved = joins.resolve_report_url(registry, 2024)
    found = resolved.select("ticker", F.col("report_url").alias("outcome"), "target")
    missing = unresolved.select(
        "ticker", F.col("error").alias("outcome"), file_key("ticker", F.lit(2024)).alias("target")
    )
    return found.unionByName(missing)


@query
def nation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lookup: the suppliers of one nation, found by its name."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    suppliers = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )
    found = joins.lookup(nations, suppliers.select("n_name", "s_suppkey", "s_name"), "n_name", "NATION_3")
    return found.select("n_name", "s_suppkey", "s_name")
