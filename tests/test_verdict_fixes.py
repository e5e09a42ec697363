"""Values that do not fit, gaps in page numbers, long reports, ties and repeated decisions."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.test_star import landing, lists
from tracebook.operators import pages, payloads, star
from tracebook.plans.disclosures import build
from tracebook.sources import scans, sinks
from tracebook.streaming import landing as streams

GOOD = {
    "company_ticker": "ABC", "fiscal_year": 2024, "esrs_topic": "E1", "esrs_disclosure": "E1-6",
    "metric_name": "Total Scope 1", "value_numeric": 5.0, "unit": "t", "confidence_score": 0.9,
    "source_citation": {"page": 3, "snippet": "a quote of twenty characters"}, "language": "en",
    "extraction_timestamp": "2024-05-01T00:00:00Z",
}


@pytest.fixture
def archive(tmp_path):
    from tracebook.fixed_values import MODELS

    rows = [{**GOOD, "extraction_model": MODELS[0], "unit": f"u{i}"} for i in range(6)]
    rows[1]["confidence_score"] = 1.0004
    rows[2]["confidence_score"] = 12.0
    rows[3]["value_numeric"] = 1e30
    rows[4] |= {"value_numeric": None, "value_text": "x" * 900}
    rows[5]["fiscal_year"] = 2025
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(rows))
    return tmp_path


def test_values_are_judged_before_they_are_cast(spark, archive):
    valid, invalid = scans.archive_rows(spark, str(archive / "in"))
    assert sorted(r.unit for r in valid.collect()) == ["u0", "u5"]
    said = {r.unit: r.violations for r in invalid.collect()}
    assert said == {
        "u1": ["confidence_score_range"],
        "u2": ["confidence_score_range"],
        "u3": ["value_numeric_fits"],
        "u4": ["value_text_limit"],
    }


def test_stream_lands_by_year_and_goes_on_after_odd_values(spark, archive):
    table, rejects = str(archive / "table"), str(archive / "rejects")
    stream = streams.archive_stream(spark, str(archive / "in"))
    streams.land_stream(stream, table, rejects, str(archive / "check")).awaitTermination()
    landed = streams.landed_rows(spark, table)
    assert landed.count() == 2
    plan = landed.where("fiscal_year = 2025")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fiscal_year" in plan


def test_reload_replaces_every_year_in_any_mode(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.reload_rows(landing(spark), str(tmp_path / "raw"))
        sinks.reload_rows(landing(spark).where("fiscal_year = 2024").limit(1), str(tmp_path / "raw"))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert scans.raw_table(spark, str(tmp_path / "raw")).count() <= 1


def test_excerpt_head_with_gaps_in_page_numbers(spark):
    table = spark.createDataFrame([(1, 1, "one"), (1, 900, "two")], "report_id int, page int, text string")
    (row,) = pages.topic_excerpts(table, {"E1": ("nothing",)}, 100).collect()
    assert row.from_head and row.excerpt == "[page 1]\none\n\n[page 900]\ntwo"


def test_reports_of_more_pages_than_the_cap_split_whole(spark):
    table = spark.range(1, 451).select(
        F.lit(1).alias("report_id"), F.col("id").cast("int").alias("page"), F.lit("t").alias("text")
    )
    text = pages.assemble_reports(table, max_pages=None).select("report_id", "text")
    assert pages.split_report(text).count() == 450
    assert pages.assemble_reports(table).first().page_count == 200


def test_repeated_decisions_do_not_multiply_rows(spark):
    house = build(landing(spark), *lists(spark))
    ids = [r.disclosure_id for r in house.fact.select("disclosure_id").limit(2).collect()]
    rows = [(i, a, t) for i in ids for a, t in ((True, 1), (False, 2), (False, 2))]
    approvals = spark.createDataFrame(rows, "disclosure_id string, human_approved boolean, decided_at int")
    decided = build(landing(spark), *lists(spark), approvals)
    assert decided.wide.count() == house.wide.count()
    assert {r.human_approved for r in star.latest_decisions(approvals).collect()} == {False}


def test_failed_work_keeps_the_messages_of_its_attempts(spark):
    attempts = spark.createDataFrame(
        [(1, "E1", "m1", 0, "timeout", False), (1, "E1", "m2", 1, None, False), (2, "E1", "m1", 0, None, True),
         (2, "E1", "m2", 0, None, True)],
        "report_id int, topic string, model string, priority int, error string, accepted boolean",
    )
    work = spark.createDataFrame([(1, "E1"), (2, "E1"), (3, "E1")], "report_id int, topic string")
    found = {r.report_id: r for r in payloads.attempt_outcomes(work, attempts).collect()}
    assert found[1].error == "m1: timeout; m2: payload refused"
    assert found[2].error is None and found[2].model == "m1"
    assert found[3].error == "no attempt"


def test_declared_marts_keep_their_types(spark):
    from tracebook.schemas import MARTS, RAW

    sinks.create_layers(spark, RAW)
    narrow = landing(spark).select(F.lit("k").alias("period_id"), F.col("fiscal_year").cast("long"),
                                   *[F.lit(None).cast("date").alias(c) for c in ("period_start", "period_end")],
                                   F.lit("x").alias("reporting_basis"))
    stored = sinks.as_table(narrow, "marts.dim_period", MARTS["dim_period"])
    assert dict(stored.dtypes)["fiscal_year"] == "smallint"
    assert sinks.as_table(narrow.limit(1), "marts.dim_period", MARTS["dim_period"]).count() == 1
