from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tracebook.operators import pages
from tracebook.plans.disclosures import prompts
from tracebook.schemas import PAGES

TOPICS = {"A": ("alpha", "beta 2"), "B": ("gamma",), "C": ("never there",)}


def whole_text(texts):
    return "\n\n".join(f"[page {i + 1}]\n{t}" for i, t in enumerate(texts))


def expected_excerpt(texts, words, budget):
    """Plain statement of the page filter: (pages, from_head, excerpt)."""
    last = len(texts)
    chosen, total = [], 0
    for number, body in enumerate(texts, start=1):
        chunk = f"[page {number}]\n{body}" + ("" if number == last else "\n\n")
        if not any(word in chunk.lower() for word in words):
            continue
        if total + len(chunk) > budget:
            break
        chosen.append(chunk)
        total += len(chunk)
    if not chosen:
        return 0, True, whole_text(texts)[:budget]
    return len(chosen), False, "\n\n".join(chosen)


def page_table(spark, reports):
    return spark.createDataFrame(
        [(r, i + 1, t) for r, texts in reports.items() for i, t in enumerate(texts)], PAGES
    )


def check(spark, reports, budget, split=None):
    got = {
        (r.report_id, r.topic): (r.page_count, r.from_head, r.excerpt)
        for r in pages.topic_excerpts(page_table(spark, reports), TOPICS, budget, split).collect()
    }
    expected = {
        (report, topic): expected_excerpt(texts, words, budget)
        for report, texts in reports.items()
        for topic, words in TOPICS.items()
    }
    assert got == expected


def test_excerpts_against_brute_force(spark):
    random.seed(3)
    words = ["ALPHA", "beta 2", "gamma", "other", "words", "é", ""]
    for budget in (30, 60, 200):
        reports = {
            f"r{n}": [
                " ".join(random.choice(words) for _ in range(random.randint(0, 8)))
                for _ in range(random.randint(1, 12))
            ]
            for n in range(25)
        }
        check(spark, reports, budget)


def test_budget_edges(spark):
    exact = len("[page 1]\nalpha\n\n")
    reports = {
        "exact": ["alpha", "rest"],
        "break": ["alpha", "alpha " + "x" * 50, "alpha"],  # a later page that would fit stays out
        "first_too_big": ["alpha " + "x" * 90, "alpha"],
        "no_hit": ["nothing", "here", "at all"],
        "last": ["x", "alpha"],
        "empty": [""],
    }
    check(spark, reports, exact)
    check(spark, reports, 2 * exact - 2)


def test_hot_report_is_cut_in_slices_without_changing_the_result(spark):
    random.seed(5)
    hot = [random.choice(["alpha", "gamma", "filler text"]) * random.randint(1, 3) for _ in range(3000)]
    reports = {"hot": hot, **{f"r{n}": ["alpha", "x"] for n in range(20)}}
    for split in (1, 7, 64):
        check(spark, reports, 900, split)


def test_prefix_survivors_are_bounded(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.col("id").alias("p"), F.lit(10).alias("n"))
    seen = []

    def between(survivors):
        seen.append(survivors.count())
        return survivors

    lane = pages.Lane(F.col("n"), 100)
    kept = pages.prefix_within_budget(df, ["g"], ["p"], {"l": lane}, between, split=8)
    assert rows(kept, "p") == sorted([(p,) for p in range(10)], key=repr)
    assert seen[0] <= 8 * 11


def test_page_rows_caps_and_fills(spark):
    df = spark.createDataFrame([("r", 1, None), ("r", 2, "b"), ("r", 3, "c")], PAGES)
    assert rows(pages.page_rows(df, 2), "page", "text") == [(1, ""), (2, "b")]
    assert pages.page_rows(df, None).count() == 3


def test_split_and_assemble_are_inverse(spark):
    reports = {"a": ["one", "", "three\nlines"], "b": ["x"]}
    assembled = pages.assemble_reports(page_table(spark, reports))
    assert {r.report_id: (r.text, r.page_count) for r in assembled.collect()} == {
        k: (whole_text(v), len(v)) for k, v in reports.items()
    }
    again = pages.split_report(assembled.select("report_id", "text"))
    chunks = {}
    for r in again.orderBy("page").collect():
        chunks.setdefault(r.report_id, []).append(r.chunk)
    assert {k: "".join(v) for k, v in chunks.items()} == {k: whole_text(v) for k, v in reports.items()}


def test_split_drops_text_before_the_first_header(spark):
    df = spark.createDataFrame([("r", "cover\n[page 7]\nbody [page x]\n\n[page 12]\nend")], "report_id string, text string")
    got = pages.split_report(df).orderBy("page").collect()
    assert [(r.page, r.chunk) for r in got] == [(7, "[page 7]\nbody [page x]\n\n"), (12, "[page 12]\nend")]


def test_prompts_for_every_report_and_topic(spark):
    table = page_table(spark, {"r1": ["climate plan", "x"], "r2": ["nothing"]})
    companies = spark.createDataFrame(
        [("r1", "First", "fr"), ("r2", "Second", "en")], "report_id string, name string, language string"
    )
    got = {(r.report_id, r.topic): r.prompt for r in prompts(table, companies).collect()}
    assert len(got) == 10
    one = got[("r1", "E1")]
    assert "Company: First\n" in one and "Topic: E1\n" in one and "Language: fr\n" in one
    assert "  - E1-6: Total Scope 1 GHG emissions (unit: tCO2e)\n" in one
    assert one.endswith("---\n[page 1]\nclimate plan\n\n\n---\n")
    assert got[("r2", "G1")].endswith("---\n[page 1]\nnothing\n---\n")
