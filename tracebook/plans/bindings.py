"""Every operator on the test tables; ``oracles.py`` holds the matching SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracebook.fixed_values import METRIC_CATALOGUE
from tracebook.functions import display, rules, scoring
from tracebook.functions.keys import file_key, parent_code, surrogate_key
from tracebook.operators import joins, pages, payloads, quality, reports, star
from tracebook.operators.containment import containment_pairs
from tracebook.operators.numbering import number_within
from tracebook.operators.picks import first_per_key, latest_per_key, preferred_first, top_one
from tracebook.operators.snapshot import nested_documents
from tracebook.plans.tables import table
from tracebook.schemas import SCORE_TYPE
from tracebook.sources.scans import admitted_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
LANGUAGE_ORDER = ("fr", "en", "de", "es")
MONTH = tuple(f"2024-01-{day:02d}" for day in range(1, 32))
LINE_TOPICS = {
    "legal": ("license", "copyright", "all rights"),
    "contact": ("@", "phone", "http"),
    "access": ("token", "password", "secret"),
}
CHAT_TOPICS = {"E1": ("energ", "climate", "ation"), "S1": ("employ", "diente"), "G1": ("ethics", "lobby")}
BUDGET = 1500
# of all years; one customer in eight has none, which gives missing parents and nulls
URGENT = "o_orderpriority = '1-URGENT'"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def stamp(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def score_of(value: Column) -> Column:
    return F.round(value.cast("decimal(18,6)"), 3).cast(SCORE_TYPE)


# ---- latest rows and routing ---------------------------------------------------------


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ["event_id"])


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = score_of(F.least(F.col("value"), F.lit(100.0)) / 100)
    return latest_events(spark, sf_dir).withColumn("score", score)


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a score from their length and an approval where they are labelled."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    length = F.least(F.col("n_chars"), F.lit(2000)).cast("decimal(10,0)")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        "lang",
        "source",
        "toxic",
        F.round(length / 2000, 3).cast(SCORE_TYPE).alias("score"),
        (F.col("quality") == 1).alias("approved"),
    )


@query
def latest_event_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_events(spark, sf_dir).select(
        "user_id", "event_type", "event_id", stamp("ts").alias("ts"), "value", "props"
    )


@query
def latest_line_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_lines(spark, sf_dir).withColumn("l_shipdate", display.iso_date(F.col("l_shipdate")))


@query
def route_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.route_summary(scored_events(spark, sf_dir), "score")


@query
def band_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_events(spark, sf_dir).select(
        "user_id", "event_type", scoring.band(F.col("score")).alias("band")
    )


@query
def published_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = judged_documents(spark, sf_dir)
    keep = star.is_published(F.col("score"), F.col("approved"))
    return docs.where(keep).select(
        F.col("doc_id").alias("document_id"), "lang", "source", F.col("score").cast("double")
    )


@query
def review_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = judged_documents(spark, sf_dir)
    keep = star.is_for_review(F.col("score"), F.col("approved"))
    return docs.where(keep).select(
        F.col("doc_id").alias("document_id"),
        "lang",
        "source",
        F.col("score").cast("double"),
        F.coalesce("approved", F.lit(False)).alias("human_approved"),
    )


@query
def rejected_wins_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = judged_documents(spark, sf_dir)
    score, approved = F.col("score"), F.col("approved")
    route = F.when(star.is_published(score, approved, rejected_wins=True), "published").when(
        star.is_for_review(score, approved, rejected_wins=True), "review"
    )
    return docs.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("docs"))


@query
def routes_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = judged_documents(spark, sf_dir)
    score, approved = F.col("score"), F.col("approved")
    published = docs.where(star.is_published(score, approved))
    review = docs.where(star.is_for_review(score, approved))
    toxic = docs.where("toxic = 1")
    pairs = {"published_review": (published, review), "published_toxic": (published, toxic)}
    found = [
        quality.common_keys(left, right, ["doc_id"]).select(F.lit(name).alias("pair"), "doc_id")
        for name, (left, right) in pairs.items()
    ]
    return found[0].unionByName(found[1])


# ---- star ----------------------------------------------------------------------------


def supplier_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.keyed(table(spark, sf_dir, "supplier"), "supplier_id", ["s_suppkey"])


def part_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    natural = ["p_brand", "p_name"]
    catalogue = parts.where("p_type = 'PROMO'").select(*natural, "p_type").distinct()
    merged = star.extend_dimension(catalogue, parts, natural, ["p_type"])
    return merged.select(surrogate_key(*natural).alias("part_id"), "*")


def period_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    years = orders.select(F.year("o_orderdate").alias("ship_year")).distinct()
    reported = years.where(F.col("ship_year").between(1996, 1999))
    return star.keyed(reported, "period_id", ["ship_year"])


def line_dimensions(spark: SparkSession, sf_dir: str) -> list[star.Dimension]:
    return [
        star.Dimension(supplier_dimension(spark, sf_dir), "supplier_id", {"l_suppkey": "s_suppkey"}),
        star.Dimension(
            part_dimension(spark, sf_dir), "part_id", {"p_brand": "p_brand", "p_name": "p_name"}
        ),
        star.Dimension(period_dimension(spark, sf_dir), "period_id", {"ship_year": "ship_year"}),
    ]


def wide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest lines with their part's natural key, joined with all three dimensions."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    lines = latest_lines(spark, sf_dir)
    named = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        surrogate_key("l_orderkey", "l_linenumber").alias("line_id"),
        "l_suppkey",
        "p_brand",
        "p_name",
        F.year("l_shipdate").alias("ship_year"),
        "l_quantity",
        "l_extendedprice",
    )
    wide = star.join_dimensions(named, line_dimensions(spark, sf_dir))
    return wide.withColumn("human_approved", F.lit(None).cast("boolean"))


@query
def dim_supplier_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_dimension(spark, sf_dir)


@query
def dim_part_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_dimension(spark, sf_dir).withColumn("mandatory_flag", F.col("is_in_catalog"))


@query
def part_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.attribute_conflicts(table(spark, sf_dir, "part"), ["p_brand", "p_name"], ["p_type"])


@query
def fact_lineitem_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_lines(spark, sf_dir).select(
        "line_id", "supplier_id", "part_id", "period_id", "l_quantity", "l_extendedprice",
        F.col("human_approved").isNull().alias("not_reviewed"),
    )


@query
def mart_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_lines(spark, sf_dir).select(
        "line_id",
        F.col("s_name").alias("supplier_name"),
        "p_brand",
        "p_name",
        "p_type",
        "is_in_catalog",
        "ship_year",
        "l_quantity",
        "l_extendedprice",
    )


@query
def mart_lineitem_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart from the stored fact, re-joined on surrogate keys."""
    fact = wide_lines(spark, sf_dir).select("line_id", "part_id", "period_id", "l_quantity")
    dimensions = line_dimensions(spark, sf_dir)[1:]
    mart = star.join_on_surrogates(fact, dimensions)
    return mart.groupBy("p_type", "is_in_catalog", "ship_year").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("quantity"),
    )


# ---- registry joins and work lists ---------------------------------------------------


@query
def anti_unlabelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return joins.pending(docs, table(spark, sf_dir, "labels"), "doc_id")


@query
def semi_labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return joins.with_data(docs, table(spark, sf_dir, "labels"), "doc_id")


@query
def landed_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a delivery of 1998, found by their derived key."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ticker"), "s_name")
    lines = table(spark, sf_dir, "lineitem").where(F.year("l_shipdate") == 1998)
    shipped = lines.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.max("l_orderkey").alias("last_order")
    )
    landed = shipped.select(
        file_key("l_suppkey", "year").alias("file_key"),
        F.concat(F.lit("orders/"), F.col("last_order").cast("string")).alias("path"),
    )
    return joins.landed_reports(suppliers, landed, 1998).withColumnRenamed("ticker", "s_suppkey")


@query
def attempt_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", display.iso_date(F.col("ts")))
    users = events.select("user_id").distinct()
    failed = F.when(F.col("value") > 250, F.concat(F.lit("value "), F.lit("too high")))
    return reports.attempt_matrix(users, MONTH, events, "user_id", "day", failed)


@query
def failure_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return reports.failure_gate(events, F.col("event_type") == "error")


# ---- quality -------------------------------------------------------------------------


@query
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    urgent = orders.where(URGENT)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    check = quality.has_parent("c_custkey", urgent.select("o_custkey").distinct(), "o_custkey")
    return quality.failing_rows(customers, check)


@query
def not_null_unique_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    events = table(spark, sf_dir, "events")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labelled = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    parts = [
        (
            "lineitem",
            lines,
            [
                quality.not_null("l_orderkey"),
                quality.accepted_values("l_returnflag", ["A", "N"]),
                quality.unique("l_orderkey", "l_linenumber"),
                quality.unique("l_orderkey"),
            ],
        ),
        ("events", events, [quality.accepted_values("event_type", ["click", "view", "signup"])]),
        (
            "labelled",
            labelled,
            [
                quality.not_null("quality"),
                quality.accepted_values("quality", [1]),
                quality.accepted_values("lang", ["fr", "en"]),
                quality.unique("doc_id"),
                quality.holds("clean", (F.col("quality") == 1) | (F.col("toxic") == 0)),
            ],
        ),
    ]
    report = None
    for name, df, checks in parts:
        part = quality.summarize(df, checks).select(F.lit(name).alias("table_name"), "*")
        report = part if report is None else report.unionByName(part)
    return report


@query
def duplicate_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = quality.unique("l_orderkey", "l_linenumber")
    return quality.failing_rows(table(spark, sf_dir, "lineitem"), check)


@query
def unit_interval_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    scored = events.select("event_id", (F.col("value") / 100).alias("score"))
    return quality.failing_rows(scored, quality.in_unit_interval("score"))


@query
def value_in_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("value").cast("decimal(28,6)")).alias("number"),
        F.when(F.col("event_type") == "view", F.upper(F.substring("props", 3, 1))).alias("word"),
        "props",
    )
    failing = quality.failing_rows(events, quality.value_in_source("props", "number", "word"))
    return failing.select("event_id", F.col("number").cast("double"), "word", "props")


@query
def snippet_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    snippet = F.concat(F.lit("Total, "), F.col("props"))
    number = F.when(F.col("event_type") != "view", F.col("value") / 8)
    word = F.when(F.col("event_type") == "view", F.lit("K"))
    checked = scoring.with_snippet_match(events, "found", snippet, number, word)
    return checked.select("event_id", "found")


# ---- text ----------------------------------------------------------------------------


@query
def passage_in_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = table(spark, sf_dir, "benchmark").withColumnRenamed("text", "passage")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return containment_pairs(documents, passages, "doc_id", "item_id")


def line_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return lines.select(
        F.col("doc_id").alias("report_id"), (F.col("line") + 1).alias("page"), "text"
    )


def chat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("report_id"), (F.col("turn") + 1).cast("int").alias("page"), "text"
    )


@query
def page_keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    excerpts = pages.topic_excerpts(line_pages(spark, sf_dir), LINE_TOPICS, BUDGET)
    return excerpts.select(
        "report_id",
        "topic",
        F.col("page_count").cast("long").alias("page_count"),
        "from_head",
        F.length("excerpt").cast("long").alias("n_chars"),
        F.md5("excerpt").alias("digest"),
    )


@query
def page_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lane = pages.Lane(F.length("text"), BUDGET)
    kept = pages.prefix_within_budget(
        chat_pages(spark, sf_dir), ["report_id"], ["page"], {"budget": lane}
    )
    return kept.select("report_id", "page", F.length("text").cast("long").alias("n_chars"))


@query
def assembled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.assemble_reports(chat_pages(spark, sf_dir))


@query
def split_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    assembled = pages.assemble_reports(chat_pages(spark, sf_dir), max_pages=None).select("report_id", "text")
    return pages.split_report(assembled).select(
        "report_id", "page", F.length("chunk").cast("long").alias("chunk_chars")
    )


@query
def prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat_pages(spark, sf_dir)
    excerpts = pages.topic_excerpts(conversations, CHAT_TOPICS, BUDGET)
    companies = conversations.select("report_id").distinct().select(
        "report_id",
        F.concat(F.lit("Company "), F.col("report_id").cast("string")).alias("name"),
        F.lit("en").alias("language"),
    )
    rows = pages.prompt_rows(excerpts, companies, 2024, tuple(CHAT_TOPICS), METRIC_CATALOGUE)
    return rows.select(
        "report_id",
        "topic",
        F.length("prompt").cast("long").alias("n_chars"),
        F.md5("prompt").alias("digest"),
    )


# ---- payloads ------------------------------------------------------------------------


@query
def payload_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's JSON as a one-entry payload, parsed and coerced."""
    events = table(spark, sf_dir, "events")
    payload = F.concat(
        F.lit('{"metrics":[{"source_page":'),
        F.when(F.col("event_type") == "view", F.lit('"12"')).otherwise(F.lit("12.7")),
        F.lit(',"model_confidence":'),
        F.when(F.col("event_type") == "error", F.lit("null")).otherwise(F.lit("0.9")),
        F.lit(',"source_snippet":"s","esrs_disclosure":"E1-6.x","metric_name":"m","value_numeric":'),
        F.try_variant_get(F.try_parse_json("props"), "$.k", "string"),
        F.lit("}]"),
        F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.lit("}")),
    )
    items = payloads.with_payload_items(events, payload, "items")
    parsed = items.select(
        "event_id",
        F.col("items").isNotNull().alias("is_list"),
        F.get(payloads.coerced_items(F.col("items")), F.lit(0)).alias("e"),
    )
    return parsed.select(
        "event_id",
        "is_list",
        F.col("e.esrs_disclosure").alias("code"),
        F.col("e.source_page").alias("page"),
        F.col("e.value_numeric").alias("number"),
        F.coalesce("e.sound", F.lit(False)).alias("sound"),
    )


@query
def payload_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day: the clicks if they are all good, else the views, else failure."""
    events = table(spark, sf_dir, "events").select(
        "user_id",
        display.iso_date(F.col("ts")).alias("day"),
        "event_type",
        F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"),
    )
    work = events.select("user_id", "day").distinct()
    tried = events.where(F.col("event_type").isin("click", "view"))
    judged = payloads.all_or_nothing(tried, ["user_id", "day", "event_type"], F.col("k") < 80)
    attempts = judged.withColumn("priority", F.when(F.col("event_type") == "click", 0).otherwise(1))
    chosen = payloads.first_accepted(attempts, ["user_id", "day"])
    outcome = work.join(chosen, ["user_id", "day"], "left")
    return outcome.select(
        "user_id",
        "day",
        F.coalesce("event_type", F.lit("failed")).alias("outcome"),
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
    )


@query
def record_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    docs = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        "doc_id",
        "lang",
        "source",
        "text",
        F.col("quality").alias("first_value"),
        F.when(F.col("quality").isNull() & (F.col("lang") == "fr"), F.col("source")).alias("second_value"),
    )
    checked = rules.validate(
        docs,
        {
            "exactly_one": rules.exactly_one("first_value", "second_value"),
            "lang_value": F.col("lang").isin("fr", "en"),
            "source_length": rules.length_between("source", 5, 10),
            "text_blank": rules.not_blank("text"),
            "text_length": rules.length_between("text", 20, 2000),
        },
    )
    return checked.select(
        "doc_id",
        F.size("violations").cast("long").alias("broken"),
        F.array_join("violations", ",").alias("violations"),
    )


@query
def registry_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.regexp_extract("url", "^[^/]*//[^/]*/([a-z]+)/", 1).alias("language"),
    )
    checked = rules.validate(
        urls,
        {
            "url_http": rules.http_url("url"),
            "url_https": F.col("url").rlike("^https://"),
            "language_code": F.col("language").rlike("^(fr|en)$"),
            "url_length": rules.length_between("url", 2, 40),
        },
    )
    return checked.select("page_id", F.array_join("violations", ",").alias("violations"))


@query
def magic_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that start with the document mark and are not among the labelled ids."""
    html = table(spark, sf_dir, "pages").select("page_id", "html")
    landed = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.col("quality").alias("length")
    )
    admitted = admitted_files(html, landed, F.col("html"), "page_id", "<!DOCTYPE html>")
    return admitted.select("page_id", F.length("html").cast("long").alias("n_chars"))


# ---- scoring and codes ---------------------------------------------------------------


@query
def confidence_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    docs = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rating = F.when(F.col("source") != "src3", F.col("n_chars") / 3000.0)
    scored = scoring.with_confidence(
        docs,
        "exact_score",
        scoring.pseudo_logprob(rating),
        F.coalesce(F.col("toxic"), F.lit(0)) == 0,
        F.coalesce(F.col("quality"), F.lit(1)) == 1,
        F.col("lang").isin("fr", "en"),
    )
    return scored.select("doc_id", F.col("exact_score").cast("double").alias("score"))


@query
def parent_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    return table(spark, sf_dir, "pages").select("page_id", parent_code(host).alias("code"))


@query
def display_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    cents = F.col("value").cast("decimal(12,2)")
    number = F.when(F.col("event_type") == "click", cents * 37).when(
        F.col("event_type") == "purchase", cents
    )
    text = F.when(F.col("event_type") == "view", F.col("props"))
    unit = F.when(F.col("event_type") == "click", F.lit("EUR"))
    return events.select(
        "event_id",
        display.metric_value(number, text, unit).alias("shown"),
        display.percent(score_of(F.least(F.col("value"), F.lit(100.0)) / 100)).alias("score"),
        display.labelled(
            F.col("event_type"), {"click": "C — Click", "view": "V — View", "error": "E — Error"}
        ).alias("label"),
        F.upper("event_type").alias("code"),
        display.iso_date(F.col("ts")).alias("day"),
        display.preview(F.concat("props", "event_type", stamp("ts")), 40).alias("preview"),
    )


# ---- reports -------------------------------------------------------------------------


@query
def count_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_by(table(spark, sf_dir, "events"), "event_type")


@query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = reports.row_counts(table(spark, sf_dir, "orders"), "o_orderstatus")
    return counted.withColumn("o_orderstatus", F.coalesce("o_orderstatus", F.lit("all")))


@query
def mean_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(URGENT)
    spent = orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").cast("decimal(14,2)").alias("score")
    )
    return reports.mean_score(table(spark, sf_dir, "customer"), spent, "c_custkey", "score")


@query
def topic_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = judged_documents(spark, sf_dir)
    return reports.topic_profile(docs, "source", "lang", "score", LANGUAGE_ORDER[:3])


def exposed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with exposure from their balance and the order chosen for them."""
    orders = table(spark, sf_dir, "orders")
    compound = (
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.year("o_orderdate") < 1999)
        & F.col("o_totalprice").isNotNull()
    )
    chosen = preferred_first(
        orders.where(compound).select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"),
        ["o_custkey"],
        F.col("o_orderstatus") == "F",
        [F.col("o_orderkey").asc()],
    )
    customers = table(spark, sf_dir, "customer")
    positive = customers.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("ticker"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("exposure_eur_m"),
    )
    amounts = chosen.select(
        F.col("o_custkey").alias("company_ticker"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("value_numeric"),
    )
    companies = customers.select(F.col("c_custkey").alias("ticker"))
    return reports.portfolio_exposures(companies, positive, amounts)


@query
def portfolio_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exposed_customers(spark, sf_dir).select(
        "ticker",
        F.col("exposure_eur_m").cast("double").alias("exposure"),
        F.coalesce("scope_1", F.lit(-1)).cast("double").alias("amount"),
        F.coalesce("intensity", F.lit(-1)).alias("intensity"),
    )


@query
def portfolio_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = reports.portfolio_totals(exposed_customers(spark, sf_dir))
    return totals.withColumns(
        {c: F.col(c).cast("double") for c in ("total_exposure", "total_amount")}
    )


@query
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(URGENT)
    customers = table(spark, sf_dir, "customer")
    return reports.coverage(
        customers.select("c_custkey"), orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey"
    )


@query
def sequence_in_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    numbered = number_within(
        orders,
        ["o_custkey"],
        [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()],
        "position",
        [F.to_date("o_orderdate")],
    )
    return numbered.select(
        "o_orderkey",
        F.concat_ws("-", F.col("o_custkey").cast("string"), F.col("position").cast("string")).alias("id"),
    )


@query
def top1_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_one(urgent_totals(spark, sf_dir), "largest", "c_name")


def urgent_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(URGENT)
    largest = orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("largest"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return customers.join(largest, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_nationkey", "c_name", "largest"
    )


@query
def top_customer_per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(
        urgent_totals(spark, sf_dir),
        ["c_nationkey"],
        [F.col("largest").desc_nulls_last(), F.col("c_name").asc()],
    )


@query
def nested_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return nested_documents(
        named,
        "n_name",
        [F.col("s_suppkey").asc()],
        {
            "supplierKey": F.col("s_suppkey"),
            "name": F.col("s_name"),
            "rating": F.when(F.col("s_acctbal") > 0, F.lit("ok")),
        },
        [F.floor(F.col("s_suppkey") / 4096)],
    )


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After keeping the latest event per (user, type): how many publish, how many wait."""
    return route_summary(spark, sf_dir)
