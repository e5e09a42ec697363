from __future__ import annotations

import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_star import PRIMARY, SECONDARY, landing, raw_row
from tracebook.operators import joins, reports, snapshot
from tracebook.operators.containment import containment_pairs
from tracebook.operators.numbering import number_by_range, number_within
from tracebook.operators.picks import latest_per_key
from tracebook.schemas import EXPOSURES, RAW


def test_route_summary_guards_the_empty_table(spark):
    scores = spark.createDataFrame([("0.9",), ("0.8",), ("0.79",)], "s string").select(
        F.col("s").cast("decimal(4,3)").alias("confidence_score"))
    assert tuple(reports.route_summary(scores).first()) == (3, 2, 1, 67, 33)
    assert tuple(reports.route_summary(scores.where("false")).first()) == (0, 0, 0, 0, 0)


def test_attempt_matrix_keeps_empty_and_failed_attempts(spark):
    companies = spark.createDataFrame([("a",), ("b",)], "ticker string")
    results = spark.createDataFrame(
        [("a", "E1", None), ("a", "E1", None), ("b", "E2", "no answer")],
        "ticker string, topic string, error string")
    got = reports.attempt_matrix(companies, ["E1", "E2"], results, "ticker", "topic", F.col("error"))
    assert rows(got) == [
        ("a", "E1", 2, "ok", None), ("a", "E2", 0, "ok", None), ("b", "E1", 0, "ok", None),
        ("b", "E2", 0, "ERR", "no answer")]


def test_failure_gate_needs_more_than_half(spark):
    def gate(failed, n):
        df = spark.range(n).select((F.col("id") < failed).alias("f"))
        return reports.failure_gate(df, F.col("f")).first().gate_broken

    assert [gate(2, 4), gate(3, 4), gate(2, 5), gate(3, 5), gate(0, 0)] == [False, True, False, True, False]


def test_counts_means_and_coverage(spark):
    staged = latest_per_key(landing(spark))
    assert rows(reports.count_by(staged, "extraction_model")) == [(PRIMARY, 6), (SECONDARY, 1)]
    assert [tuple(r) for r in reports.row_counts(staged, "company_ticker").collect()] == [
        (None, 7), ("AA.X", 5), ("BB.X", 1), ("ZZ.X", 1)]
    companies = spark.createDataFrame([("BB.X",), ("EMPTY",)], "company_ticker string")
    assert rows(reports.mean_score(companies, staged, "company_ticker", "confidence_score")) == [
        ("BB.X", 0.1), ("EMPTY", 0.0)]
    assert tuple(reports.coverage(companies, staged, "company_ticker").first()) == (1, 2)
    assert rows(joins.with_data(companies, staged, "company_ticker")) == [("BB.X",)]
    assert rows(joins.pending(companies, staged, "company_ticker")) == [("EMPTY",)]
    assert joins.lookup(companies, staged, "company_ticker", "BB.X").count() == 1
    assert joins.lookup(companies, staged, "company_ticker", "EMPTY").first().metric_name is None
    assert joins.lookup(companies, staged, "company_ticker", "nobody").count() == 0


def test_topic_profile_in_canonical_order(spark):
    staged = latest_per_key(landing(spark)).where("company_ticker = 'AA.X'")
    profile = reports.topic_profile(staged, "company_ticker", "esrs_topic", "confidence_score")
    got = [tuple(r) for r in profile.orderBy("topic_position").collect()]
    assert got == [("AA.X", "E1", 1, 2, 1, 1), ("AA.X", "E2", 2, 2, 1, 1), ("AA.X", "S1", 4, 1, 1, 0)]


def test_portfolio(spark):
    raw = spark.createDataFrame(
        [
            raw_row("AA.X", "E1-6", "A Scope 1 line", "0.300", value_numeric=Decimal(10)),
            raw_row("AA.X", "E1-6", "B scope 1 line", "0.900", value_numeric=Decimal(1000)),
            raw_row("BB.X", "E1-6", "A Scope 1 line", "0.300", value_numeric=Decimal(35)),
            raw_row("BB.X", "E1-6", "B Scope 1 line", "0.400", value_numeric=Decimal(70)),
            raw_row("CC.X", "E1-6", "Scope 1", "0.900", value_numeric=None, value_text="n/a"),
            raw_row("CC.X", "E1-5", "Scope 1", "0.900"),
        ], RAW)
    companies = spark.createDataFrame([("AA.X",), ("BB.X",), ("CC.X",), ("DD.X",)], "ticker string")
    exposures = spark.createDataFrame([("AA.X", 850), ("BB.X", 10), ("CC.X", 7)], EXPOSURES)
    result = reports.portfolio_exposures(companies, exposures, reports.scope_1_rows(raw))
    assert rows(result.withColumn("scope_1", F.col("scope_1").cast("long"))) == [
        ("AA.X", 850, 1000, 1), ("BB.X", 10, 35, 4), ("CC.X", 7, None, None), ("DD.X", 0, None, None)]
    totals = reports.portfolio_totals(result).first()
    assert (totals.total_exposure, int(totals.total_amount), totals.covered, totals.intensity) == (867, 1035, 2, 1)
    empty = reports.portfolio_totals(result.where("false")).first()
    assert (empty.total_exposure, int(empty.total_amount), empty.intensity) == (0, 0, 0)


def test_registry_joins(spark):
    registry = spark.createDataFrame(
        [("AA.X", "https://a.example/r.pdf"), ("BB.X", None)], "ticker string, known_report_url string")
    landed = spark.createDataFrame([("AA.X-2024", "/raw/AA.X-2024.pdf")], "file_key string, path string")
    assert rows(joins.landed_reports(registry, landed, 2024), "ticker", "path") == [
        ("AA.X", "/raw/AA.X-2024.pdf")]
    resolved, unresolved = joins.resolve_report_url(registry, 2024)
    assert rows(resolved, "report_url", "target") == [("https://a.example/r.pdf", "AA.X-2024.pdf")]
    assert rows(unresolved, "ticker") == [("BB.X",)]
    work = joins.work_list(registry.select("ticker"), ["E1", "S1"])
    assert rows(work) == [("AA.X", 0, "E1"), ("AA.X", 1, "S1"), ("BB.X", 0, "E1"), ("BB.X", 1, "S1")]
    reg = registry.select(F.col("ticker").alias("report_id"), "ticker", F.lit("n").alias("name"), F.lit("fr").alias("language"))
    records = spark.createDataFrame([("AA.X", 1)], "report_id string, v int")
    assert rows(joins.stamp_company(records, reg), "ticker", "language", "v") == [("AA.X", "fr", 1)]


def test_numbers_within_a_hot_group(spark):
    random.seed(2)
    data = [("hot", n) for n in random.sample(range(100000), 3000)]
    data += [(f"k{n % 700}", n) for n in range(6000)] + [(None, 5), (None, 3)]
    df = spark.createDataFrame(data, "k string, n int")
    plain = number_within(df, ["k"], [F.col("n").asc()], "i")
    blocked = number_within(
        df, ["k"], [F.col("n").asc()], "i", [F.floor(F.col("n") / 10000), F.floor(F.col("n") / 100)])
    assert blocked.columns == ["k", "n", "i"]
    assert rows(plain) == rows(blocked)


def test_numbers_by_ranges(spark):
    """A hot group lies over several ranges, equal orders too; sizes are those of the groups."""
    random.seed(3)
    data = [("hot", n) for n in random.sample(range(100000), 3000)] + [("ties", 7)] * 500
    data += [(f"k{n % 70}", n) for n in range(600)] + [(None, 5), (None, 3)]
    df = spark.createDataFrame(data, "k string, n int").repartition(6)
    found = number_by_range(df, ["k"], [F.col("n").asc()], "i", size="size")
    assert found.columns == ["k", "n", "i", "size"]
    plain = number_within(df, ["k"], [F.col("n").asc()], "i")
    assert rows(found, "k", "n", "i") == rows(plain)
    sizes = {r.k: r.size for r in found.select("k", "size").distinct().collect()}
    assert sizes["hot"] == 3000 and sizes["ties"] == 500 and sizes[None] == 2
    whole = number_by_range(df, [], [F.col("n").desc()], "i")
    assert sorted(r.i for r in whole.collect()) == list(range(len(data)))
    numbers = [r.n for r in whole.orderBy("i").collect()]
    assert numbers == sorted(numbers, reverse=True)
    assert number_by_range(df.limit(0), ["k"], [F.col("n").asc()], "i").collect() == []


def test_snapshot_of_one_metric_name_is_numbered_over_ranges(spark):
    """Orders that differ in the model only: no prefix of a name would split the ticker."""
    raw = spark.createDataFrame(
        [raw_row("AA.X", "E1-6", "one name", "0.900", extraction_model=f"m{n:04d}") for n in range(400)], RAW
    )
    staged = snapshot.staged_year(raw, 2024).repartition(4)
    numbered = number_by_range(staged, ["company_ticker"], [F.col("extraction_model").asc()], "i")
    assert [r.i for r in numbered.orderBy("extraction_model").collect()] == list(range(400))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would share a task
    try:
        ranged = staged.repartitionByRange("company_ticker", "extraction_model")
        assert ranged.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    documents = snapshot.disclosure_documents(raw, 2024, part_size=64).collect()
    assert sorted(d.part for d in documents) == list(range(7))


def test_snapshot_documents(spark):
    raw = spark.createDataFrame(
        [raw_row("AA.X", "E1-6", f"m{n:03d}", "0.900") for n in range(25)]
        + [raw_row("AA.X", "E1-6", "m001", "0.100", hour=5)]
        + [raw_row("BB.X", "S1-6", "Headcount", "0.500", value_numeric=None, value_text="Yes", unit=None)]
        + [raw_row("BB.X", "S1-6", "Old", "0.500", fiscal_year=2023)], RAW)
    documents = snapshot.disclosure_documents(raw, 2024, part_size=10).collect()
    parts = {(d.company_ticker, d.part): json.loads(d["items"]) for d in documents}
    assert sorted(parts) == [("AA.X", 0), ("AA.X", 1), ("AA.X", 2), ("BB.X", 0)]
    whole = [item for part in range(3) for item in parts[("AA.X", part)]]
    assert [i["id"] for i in whole] == [f"AA.X-{n}" for n in range(25)]
    assert [i["metricName"] for i in whole] == [f"m{n:03d}" for n in range(25)]
    assert whole[1]["confidenceScore"] == 0.1
    assert parts[("BB.X", 0)] == [{
        "id": "BB.X-0", "esrsTopic": "S1", "esrsDisclosure": "S1-6", "metricName": "Headcount",
        "valueNumeric": None, "valueText": "Yes", "unit": None, "confidenceScore": 0.5,
        "sourcePage": 1, "sourceSnippet": "a quoted text with the figure 5 in it",
        "language": "en", "extractionModel": PRIMARY}]
    companies = spark.createDataFrame(
        [("BB.X", "Beta", "s", "FR", "fr"), ("AA.X", "Alpha", "s", "FR", "en")],
        "ticker string, name string, sector string, country string, language string")
    header = json.loads(snapshot.snapshot_header(companies, 2024, "parquet").first().header)
    assert [c["ticker"] for c in header["companies"]] == ["AA.X", "BB.X"]
    assert header["fiscalYear"] == 2024 and header["warehouse"] == "parquet"


def test_containment_against_brute_force(spark):
    random.seed(9)
    vocabulary = ["ab", "abc", "c", "Fox", "jumps", "é1", "over", "x-y"]
    texts = [
        random.choice(["", " "]) + random.choice([" ", "\n", "  "]).join(
            random.choice(vocabulary) for _ in range(random.randint(0, 30)))
        for _ in range(60)
    ]
    passages = ["b", "bc", "AB", "ab c", "c fox", "x jumps", "fox jumps over", " ab ", "over\nab",
                "jumps  over", "nowhere to be found in there", ""]
    for text in random.sample(texts, 30):
        if len(text) > 6:
            start = random.randrange(len(text) - 5)
            passages.append(text[start : start + random.randint(3, 60)].upper())
    left = spark.createDataFrame(list(enumerate(texts)), "t long, text string")
    right = spark.createDataFrame(list(enumerate(passages)), "p long, passage string")
    expected = sorted(
        ((i, j) for i, t in enumerate(texts) for j, p in enumerate(passages) if p and p.lower() in t.lower()),
        key=repr)
    assert rows(containment_pairs(left, right, "t", "p")) == expected
