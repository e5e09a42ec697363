from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tracebook.operators import payloads
from tracebook.plans.disclosures import extraction
from tracebook.schemas import PAYLOADS, RAW

QUOTE = "the group emitted 5 tonnes in the year"
ITEM = {
    "esrs_disclosure": "E1-6.scope_1", "metric_name": "Total", "value_numeric": 5,
    "unit": "t", "model_confidence": 0.9, "source_page": 3, "source_snippet": QUOTE,
}


def entry(**change):
    merged = {**ITEM, **change}
    return {k: v for k, v in merged.items() if v is not ...}


def payload(*items):
    return json.dumps({"metrics": list(items)})


def companies(spark, *names):
    return spark.createDataFrame(
        [(n, f"{n}.XX", f"Company {n}", "en") for n in names],
        "report_id string, ticker string, name string, language string",
    )


def judge(spark, *texts, error=None):
    df = spark.createDataFrame(
        [(f"r{i:02d}", "E1", "claude-sonnet-4-6", 0, t, error) for i, t in enumerate(texts)], PAYLOADS
    )
    return payloads.judged_attempts(df).orderBy("report_id").collect()


def test_acceptance_of_payload_forms(spark):
    cases = {
        payload(entry()): True,
        payload(): True,
        "{}": True,
        '{"metrics": "x"}': False,
        '{"metrics": [1]}': False,
        '{"metrics": null}': False,
        "[1]": False,
        "not json": False,
        payload(entry()) + " and more": False,
        payload(entry(), entry(source_snippet="short")): False,
        payload(entry(source_page="42")): True,
        payload(entry(source_page="4.2")): False,
        payload(entry(source_page=3.7)): True,
        payload(entry(source_page=0)): False,
        payload(entry(source_page=...)): False,
        payload(entry(model_confidence=None)): False,
        payload(entry(model_confidence=...)): True,
        payload(entry(model_confidence="0.9")): True,
        payload(entry(model_confidence="high")): False,
        payload(entry(value_numeric="5")): False,
        payload(entry(value_numeric=None)): False,
        payload(entry(value_numeric=None, value_text="Yes")): True,
        payload(entry(value_text="Yes")): False,
        payload(entry(value_numeric=None, value_text=5)): False,
        payload(entry(metric_name=...)): False,
        payload(entry(esrs_disclosure="E")): False,
    }
    got = judge(spark, *cases)
    for (text, expected), row in zip(cases.items(), got):
        assert row.accepted is expected, text


def test_null_payload_and_reported_error_are_refused(spark):
    assert [r.accepted for r in judge(spark, None)] == [False]
    assert [r.accepted for r in judge(spark, payload(entry()), error="timeout")] == [False]


def test_coercion_of_fields(spark):
    record = judge(spark, payload(entry(source_page=3.7, model_confidence="0.9", unit=None)))[0].records[0]
    assert (record.esrs_disclosure, record.source_page, record.model_confidence) == ("E1-6", 3, 0.9)
    assert (record.value_numeric, record.value_text, record.unit) == (5.0, None, None)


def test_fallback_and_failure(spark):
    first, second = "claude-sonnet-4-6", "mistral-large-latest"
    tried = [
        ("a", "E1", first, 0, payload(entry()), None),
        ("a", "E1", second, 1, payload(entry(metric_name="Other")), None),
        ("a", "E2", first, 0, None, "timeout"),
        ("a", "E2", second, 1, payload(entry(), entry(metric_name="Second")), None),
        ("a", "E3", first, 0, payload(), None),
        ("a", "E3", second, 1, payload(entry()), None),
        ("a", "S1", first, 0, "broken", None),
        ("a", "S1", second, 1, "broken too", None),
    ]
    result = extraction(
        spark.createDataFrame(tried, PAYLOADS), companies(spark, "a"), 2024, F.lit("2024-05-01").cast("timestamp")
    )
    outcome = {r.topic: (r.model, r.error is None) for r in result.outcomes.collect()}
    assert outcome == {
        "E1": (first, True),
        "E2": (second, True),
        "E3": (first, True),  # an empty list is a success, not a reason to fall back
        "S1": (None, False),
        "G1": (None, False),
    }
    landed = result.rows
    assert landed.schema.fieldNames() == RAW.fieldNames()
    assert rows(landed, "company_ticker", "esrs_topic", "metric_name", "confidence_score") == [
        ("a.XX", "E1", "Total", Decimal("0.900")),
        ("a.XX", "E2", "Second", Decimal("0.900")),
        ("a.XX", "E2", "Total", Decimal("0.900")),
    ]
    assert result.rejected.count() == 0


def test_score_is_halved_when_the_quote_lacks_the_value(spark):
    tried = [("a", "E1", "claude-sonnet-4-6", 0, payload(entry(value_numeric=77)), None)]
    result = extraction(spark.createDataFrame(tried, PAYLOADS), companies(spark, "a"))
    assert rows(result.rows, "confidence_score") == [(Decimal("0.450"),)]


def test_language_mismatch_costs_thirty_percent(spark):
    df = spark.createDataFrame(
        [(QUOTE, 5.0, None, 1.0, False)],
        "source_snippet string, value_numeric double, value_text string, "
        "model_confidence double, language_match boolean",
    )
    assert rows(payloads.score_records(df), "confidence_score") == [(Decimal("0.700"),)]


def test_all_or_nothing_over_item_rows(spark):
    df = spark.createDataFrame([(1, True), (1, True), (2, True), (2, None), (3, False)], "k int, ok boolean")
    got = rows(payloads.all_or_nothing(df, ["k"], F.col("ok")), "k", "accepted", "item_count")
    assert got == [(1, True, 2), (2, False, 2), (3, False, 1)]
