from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracebook.operators import quality, star
from tracebook.operators.picks import first_per_key, latest_per_key, preferred_first, top_one
from tracebook.plans.disclosures import build, run_checks, seed_report
from tracebook.schemas import APPROVALS, COMPANIES, METRICS, PERIODS, RAW

PRIMARY, SECONDARY = "claude-sonnet-4-6", "mistral-large-latest"


def raw_row(ticker, code, name, score, hour=1, **change):
    row = {
        "company_ticker": ticker, "fiscal_year": 2024, "esrs_topic": code[:2],
        "esrs_disclosure": code, "metric_name": name, "value_numeric": Decimal(5),
        "value_text": None, "unit": "t", "confidence_score": Decimal(score), "source_page": 1,
        "source_snippet": "a quoted text with the figure 5 in it", "language": "en",
        "extraction_model": PRIMARY, "extraction_timestamp": datetime(2024, 5, 1, hour),
    }
    row.update(change)
    return tuple(row[f] for f in RAW.fieldNames())


def lists(spark):
    companies = spark.createDataFrame(
        [("AA.X", "Alpha", "Energy", "FR", "https://a.example", "en"),
         ("BB.X", "Beta", "Banking", "FR", "https://b.example", "fr")], COMPANIES)
    catalogue = spark.createDataFrame(
        [("E1", "E1-6", "Scope 1 total", "t"), ("S1", "S1-6", "Headcount", "count")], METRICS)
    periods = spark.createDataFrame([(2024, date(2024, 1, 1), date(2024, 12, 31), "basis")], PERIODS)
    return companies, catalogue, periods


def landing(spark):
    return spark.createDataFrame(
        [
            raw_row("AA.X", "E1-6", "Scope 1 total", "0.500", 1),
            raw_row("AA.X", "E1-6", "Scope 1 total", "0.900", 3),  # the newest run wins
            raw_row("AA.X", "E1-6", "Scope 1 total", "0.700", 2),
            raw_row("AA.X", "E1-6", "Scope 1 total", "0.790", 1, extraction_model=SECONDARY),
            raw_row("AA.X", "E2-4", "NOx", "0.800"),  # two metrics under one code, not listed
            raw_row("AA.X", "E2-4", "SOx", "0.799"),
            raw_row("BB.X", "E2-4", "NOx", "0.100", unit="kg"),  # same metric, other unit
            raw_row("ZZ.X", "E1-6", "Scope 1 total", "0.900"),  # unknown company
            raw_row("AA.X", "S1-6", "Headcount", "0.900", fiscal_year=2023),  # unknown year
        ],
        RAW,
    )


def test_latest_row_wins_whatever_the_arrival_order(spark):
    first = landing(spark)
    second = first.orderBy(F.rand(3)).repartition(3)
    assert rows(latest_per_key(first)) == rows(latest_per_key(second))
    staged = latest_per_key(first)
    assert staged.count() == 7
    assert rows(latest_per_key(staged)) == rows(staged)
    newest = staged.where("extraction_model = 'claude-sonnet-4-6' and metric_name = 'Scope 1 total'")
    assert rows(newest.where("company_ticker = 'AA.X'"), "confidence_score") == [(Decimal("0.900"),)]


def test_equal_times_are_settled(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "c"), ("k", 1, "a")], "k string, t int, v string")
    assert rows(latest_per_key(df, ["k"], "t")) == [("k", 1, "c")]


def test_metric_dimension_extends_itself_with_unique_keys(spark):
    companies, catalogue, periods = lists(spark)
    house = build(landing(spark), companies, catalogue, periods)
    assert rows(house.metrics, "metric_name", "unit", "mandatory_flag", "is_in_catalog") == sorted(
        [("Scope 1 total", "t", True, True), ("Headcount", "count", True, True),
         ("NOx", "kg", False, False), ("SOx", "t", False, False)], key=repr)
    assert house.metrics.select("metric_id").distinct().count() == 4
    conflicts = star.attribute_conflicts(
        house.staged, ["esrs_disclosure", "metric_name"], ["esrs_topic", "unit"])
    assert rows(conflicts, "metric_name", "variants") == [("NOx", 2)]


def test_fact_and_routes(spark):
    companies, catalogue, periods = lists(spark)
    house = build(landing(spark), companies, catalogue, periods)
    assert house.fact.columns == list(star.FACT_COLUMNS)
    assert house.fact.count() == 5  # unknown company and year drop out
    assert house.fact.where("human_approved is not null").count() == 0
    assert dict(house.fact.dtypes)["human_approved"] == "boolean"
    assert rows(house.published, "metric_name", "confidence_score") == [
        ("NOx", Decimal("0.800")), ("Scope 1 total", Decimal("0.900"))]
    assert rows(house.review, "metric_name", "human_approved") == [
        ("NOx", False), ("SOx", False), ("Scope 1 total", False)]
    assert len(house.published.columns) == 18 and len(house.review.columns) == 19
    both = house.published.select("disclosure_id").union(house.review.select("disclosure_id"))
    assert rows(both) == rows(house.fact, "disclosure_id")


def test_approvals_move_rows(spark):
    companies, catalogue, periods = lists(spark)
    plain = build(landing(spark), companies, catalogue, periods)
    ids = {(r.metric_name, r.company_ticker): r.disclosure_id for r in plain.wide.collect()}
    approvals = spark.createDataFrame(
        [(ids[("SOx", "AA.X")], True), (ids[("NOx", "AA.X")], False)], APPROVALS)
    house = build(landing(spark), companies, catalogue, periods, approvals)
    assert rows(house.published, "metric_name") == [("NOx",), ("SOx",), ("Scope 1 total",)]
    strict = build(landing(spark), companies, catalogue, periods, approvals, rejected_wins=True)
    assert rows(strict.published, "metric_name") == [("SOx",), ("Scope 1 total",)]
    assert rows(strict.review, "metric_name", "company_ticker") == [
        ("NOx", "AA.X"), ("NOx", "BB.X"), ("Scope 1 total", "AA.X")]


def test_wide_mart_equals_surrogate_joins(spark):
    companies, catalogue, periods = lists(spark)
    house = build(landing(spark), companies, catalogue, periods)
    company = house.companies.select(
        "company_id", F.col("ticker").alias("company_ticker"), F.col("name").alias("company_name"),
        "sector", "country")
    metric = house.metrics.select("metric_id", "esrs_topic", "esrs_disclosure", "metric_name")
    period = house.periods.select("period_id", "fiscal_year")
    joined = star.join_on_surrogates(
        house.fact,
        [star.Dimension(company, "company_id", {}), star.Dimension(metric, "metric_id", {}),
         star.Dimension(period, "period_id", {})])
    assert rows(star.published_mart(joined)) == rows(house.published)
    assert rows(star.review_mart(joined)) == rows(house.review)


def test_long_catalogues_are_joined(spark):
    """The catalogue's topic counts for listed metrics, the row's own for others, either way."""
    companies, catalogue, periods = lists(spark)
    catalogue = catalogue.union(spark.createDataFrame([("G1", "E2-4", "NOx", "t"), ("G1", None, "x", "t")], METRICS))
    as_value = build(landing(spark), companies, catalogue, periods)
    joined = build(landing(spark), companies, catalogue, periods, listed="join")
    assert rows(as_value.wide, *sorted(as_value.wide.columns)) == rows(joined.wide, *sorted(joined.wide.columns))
    assert set(rows(as_value.wide, "metric_name", "esrs_topic")) == {("NOx", "G1"), ("SOx", "E2"), ("Scope 1 total", "E1")}
    nothing = build(landing(spark), companies, catalogue.limit(0), periods)
    assert nothing.fact.count() == as_value.fact.count()
    many = landing(spark).withColumn("t", star.listed_topic(catalogue, bound=2))
    with pytest.raises(Exception, match="more than 2 listed metrics"):
        many.collect()


def test_fused_checks_count_like_single_ones(spark):
    df = spark.createDataFrame(
        [("a", 1, True), ("a", 1, True), ("b", None, False), (None, 3, False), ("c", 3, None), ("c", 4, False)],
        "k string, n int, side boolean",
    )
    checks = [quality.not_null("k"), quality.unique("k"), quality.unique("k", "n"), quality.accepted_values("n", [1])]
    both = quality.DisjointCheck("apart", "n", F.col("side"), ~F.col("side"))
    kinds = [quality.CheckedTable("all", checks), quality.CheckedTable("true", checks, F.col("side")),
             quality.CheckedTable("both", [both])]
    found = {(r.table_name, r.check_name): r.failures for r in quality.fused_report([(df, kinds)]).collect()}
    for name, part in (("all", df), ("true", df.where("side"))):
        for r in quality.summarize(part, checks).collect():
            assert found.pop((name, r.check_name)) == r.failures
    assert found == {("both", "apart"): 0}
    mixed = df.union(spark.createDataFrame([("z", 1, False)], df.schema))
    assert quality.fused_report([(mixed, kinds[2:])]).first().failures == 1


def test_rows_without_parents_are_counted(spark):
    companies, catalogue, periods = lists(spark)
    house = build(landing(spark), companies, catalogue, periods)
    lost = house.joined.select(
        F.count_if(~F.col("has_company")), F.count_if(~F.col("has_period")), F.count_if(~F.col("has_metric"))
    ).first()
    assert tuple(lost) == (1, 1, 0)


def test_declared_checks_of_a_build(spark):
    companies, catalogue, periods = lists(spark)
    raw = landing(spark)
    house = build(raw, companies, catalogue, periods)
    report = run_checks(house, raw, ("FR",)).collect()
    # 51 declared checks and the three checks over score, source text and routes
    assert len(report) == 54
    assert [(r.table_name, r.check_name) for r in report if not r.passed] == []


def test_checks_find_what_is_wrong(spark):
    df = spark.createDataFrame(
        [("a", 1, "0.5"), ("a", 1, "1.5"), ("b", None, "-0.1"), (None, 3, None)],
        "k string, parent int, score string").withColumn("score", F.col("score").cast("decimal(4,3)"))
    parents = spark.createDataFrame([(1,)], "id int")
    checks = [
        quality.not_null("k"), quality.accepted_values("k", ["a"]), quality.unique("k"),
        quality.unique("k", "parent"), quality.has_parent("parent", parents, "id"),
        quality.in_unit_interval("score"), quality.holds("small", F.col("score") < 1),
    ]
    got = [(r.failures, r.passed) for r in quality.summarize(df, checks).collect()]
    assert sorted(got) == sorted([(1, False)] * 3 + [(1, False)] * 2 + [(2, False)] + [(1, False)])
    assert rows(quality.failing_rows(df, checks[4]), "parent") == [(3,)]
    assert rows(quality.failing_rows(df, checks[2])) == [("a", 2)]
    assert rows(quality.failing_rows(df, checks[5]), "score") == [
        (Decimal("-0.100"),), (Decimal("1.500"),)]


def test_seed_expectations(spark):
    df = spark.createDataFrame([("AA.X",), ("AA.X",)], "ticker string")
    report = quality.seed_expectations(df, "companies", 10, ["ticker", "name"], [quality.unique("ticker")])
    assert rows(report) == [
        ("columns(companies)", 1, False), ("row_count(companies)", 8, False), ("unique(ticker)", 1, False)]


def test_seed_report(spark):
    companies, catalogue, periods = lists(spark)
    report = {r.check_name: r.failures for r in seed_report(companies, catalogue, periods).collect()}
    assert report == {
        "row_count(companies)": 8, "columns(companies)": 0, "unique(ticker)": 0,
        "accepted_values(language)": 0, "row_count(metrics)": 17, "columns(metrics)": 0,
        "accepted_values(esrs_topic)": 0, "unique(esrs_disclosure, metric_name)": 0,
        "row_count(periods)": 0, "columns(periods)": 0, "unique(fiscal_year)": 0,
    }


def test_common_keys_are_distinct(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(quality.common_keys(left, right, ["k"])) == [(1,)]


def test_preferred_and_top_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.3), ("a", 2, 0.9), ("a", 3, 0.95), ("b", 1, 0.1), ("b", 2, 0.2), ("c", 1, None)],
        "k string, n int, s double")
    got = preferred_first(df, ["k"], F.col("s") >= 0.8, [F.col("n").asc()])
    assert rows(got, "k", "n") == [("a", 2), ("b", 1), ("c", 1)]
    assert rows(first_per_key(df, ["k"], [F.col("n").desc()]), "k", "n") == [("a", 3), ("b", 2), ("c", 1)]
    tables = spark.createDataFrame([("x", None), ("y", 5), ("w", 5)], "name string, n int")
    assert top_one(tables, "n", "name").first().name == "w"
    assert top_one(tables.where("n is null"), "n", "name").first().name == "x"


@pytest.mark.parametrize("score, approved, published, review", [
    ("0.810", None, True, False), ("0.790", None, False, True), ("0.500", True, True, False),
    ("0.500", False, False, True), ("0.900", False, True, False), (None, None, None, None),
])
def test_routes_exclude_each_other(spark, score, approved, published, review):
    df = spark.createDataFrame([(score, approved)], "s string, a boolean").withColumn(
        "s", F.col("s").cast("decimal(4,3)"))
    got = df.select(
        star.is_published(F.col("s"), F.col("a")), star.is_for_review(F.col("s"), F.col("a"))).first()
    assert (bool(got[0]), bool(got[1])) == (bool(published), bool(review))
