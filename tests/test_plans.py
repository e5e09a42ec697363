"""Shapes of the physical plans, and every query against its SQL."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import connect, differences  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from tests.test_star import landing, lists  # noqa: E402
from tracebook.operators.picks import latest_per_key  # noqa: E402
from tracebook.operators.snapshot import staged_year  # noqa: E402
from tracebook.operators.pages import topic_excerpts  # noqa: E402
from tracebook.operators.star import Dimension, join_dimensions  # noqa: E402
from tracebook.plans import disclosure_bindings, disclosure_oracles  # noqa: E402, F401
from tracebook.plans.bindings import queries  # noqa: E402
from tracebook.plans.disclosures import build, extraction, run_checks  # noqa: E402
from tracebook.plans.oracles import oracle_sql  # noqa: E402
from tracebook.schemas import PAYLOADS  # noqa: E402
from tracebook.sources import scans, sinks  # noqa: E402

SMALL = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    """Sides are taken for too large to broadcast, as they are at scale."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def unpartitioned_windows(plan: str) -> list[str]:
    """Windows whose specification starts with an order instead of a partition column."""
    lines = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    return [
        line for line in lines
        if " ASC" in line.split("windowspecdefinition(", 1)[1].split(",", 1)[0]
        or " DESC" in line.split("windowspecdefinition(", 1)[1].split(",", 1)[0]
    ]


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_scales(without_broadcast, name):
    plan = physical(queries()[name](without_broadcast, SMALL))
    assert not [word for word in FORBIDDEN if word in plan]
    assert unpartitioned_windows(plan) == []
    assert "BroadcastHashJoin" not in plan  # nothing is broadcast against the size check


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_its_sql(spark, name):
    ours = queries()[name](spark, SMALL).toPandas()
    theirs = connect(SMALL).execute(oracle_sql()[name]).df()
    assert differences(ours, theirs) == []


def test_every_query_has_sql_and_the_entry_runs(spark):
    assert set(queries()) == set(oracle_sql())
    row = entry(spark).first()
    assert row.total == row.published + row.review > 0


def test_latest_row_is_limited_before_the_shuffle(spark):
    plan = physical(latest_per_key(landing(spark)))
    partial, final = plan.index("Partial"), plan.index("Final")
    assert plan.count("WindowGroupLimit") == 2
    assert final < plan.index("Exchange") < partial


def test_year_filter_prunes_partitions_below_the_window(spark, tmp_path):
    sinks.append_rows(landing(spark), str(tmp_path / "raw"))
    raw = scans.raw_table(spark, str(tmp_path / "raw"))
    plan = physical(staged_year(raw, 2024))
    assert "PartitionFilters: [isnotnull(fiscal_year" in plan and "= 2024)" in plan


def test_marts_read_raw_once_and_join_no_metrics(without_broadcast):
    spark = without_broadcast
    house = build(landing(spark), *lists(spark))
    for mart in (house.fact, house.published, house.review):
        plan = physical(mart)
        # companies and periods; metrics are named by the row's own columns
        assert plan.count("SortMergeJoin") == 2
        assert plan.count("WindowGroupLimit") == 2
    # the catalogue reaches the marts as one value, which the fact does without
    assert "hashpartitioning(esrs_disclosure" not in physical(house.fact)


def test_checks_are_one_plan_without_jobs(without_broadcast):
    spark = without_broadcast
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checks", "nothing runs while the report is planned")
    house = build(landing(spark), *lists(spark))
    report = run_checks(house, landing(spark), ("FR",))
    assert list(tracker.getJobIdsForGroup("checks")) == []
    spark.sparkContext.setJobGroup("", "")
    assert physical(report).count("Exchange ") <= 20


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(queries()["coverage"](spark, SMALL))
    scan = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "EqualTo(o_orderpriority,1-URGENT)" in scan
    assert "o_totalprice" not in scan.split("ReadSchema")[1]


def test_hot_key_gives_the_same_latest_row(spark):
    skewed = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"),
    )
    got = latest_per_key(skewed.repartition(8), ["k"], "t").where("k = 0").first()
    assert got.t == 19998


def test_payloads_are_parsed_and_scored_once(spark):
    companies = spark.createDataFrame(
        [("r", "AA.X", "Alpha", "en")],
        "report_id string, ticker string, name string, language string",
    )
    payloads = spark.createDataFrame([("r", "E1", "m", 0, "{}", None)], PAYLOADS).repartition(2)
    plan = physical(extraction(payloads, companies).rows)
    assert plan.count("parseJson") == 1
    assert plan.count("1.34217729E8") == 4  # two roundings, each naming the constant twice


def test_passage_search_runs_no_job_while_it_is_planned(spark):
    from tracebook.operators.containment import containment_pairs

    texts = spark.createDataFrame([(1, "One two THREE four five six seven"), (2, "ab"), (3, None)], "t long, text string")
    passages = spark.createDataFrame(
        [(1, "two three four five six seven"), (2, "b"), (3, "e two t"), (4, ""), (5, None), (6, "TWO three four")],
        "p long, passage string",
    )
    context = spark.sparkContext
    context.setJobGroup("planning", "passage search")
    try:
        found = {n: containment_pairs(texts, passages.where(f"p in ({n})"), "t", "p") for n in ("1", "2", "3, 6", "4, 5", "1, 2, 3, 6")}
        assert not context.statusTracker().getJobIdsForGroup("planning")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    got = {n: sorted(map(tuple, pairs.collect())) for n, pairs in found.items()}
    assert got == {"1": [(1, 1)], "2": [(2, 2)], "3, 6": [(1, 3), (1, 6)], "4, 5": [],
                   "1, 2, 3, 6": [(1, 1), (1, 3), (1, 6), (2, 2)]}


def test_page_text_is_lowered_once_for_all_topics(spark):
    pages = spark.range(10).select(
        F.lit("r").alias("report_id"), F.col("id").cast("int").alias("page"), F.lit("t").alias("text")
    ).repartition(2)
    assert physical(topic_excerpts(pages)).count("lower(") == 1


def test_hot_dimension_key_is_split_when_nothing_is_broadcast(without_broadcast):
    spark = without_broadcast
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 300000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("ticker"),
            F.md5(F.col("id").cast("string")).alias("payload"),
        )
        dimension = spark.range(500).select(
            F.col("id").alias("key"), F.concat(F.lit("n"), F.col("id")).alias("name")
        )
        wide = join_dimensions(facts, [Dimension(dimension, "key", {"ticker": "key"})])
        counted = wide.groupBy(F.length("name").alias("n")).agg(
            F.count(F.lit(1)).alias("c"), F.max("payload").alias("last")
        )
        assert sum(r.c for r in counted.collect()) == 300000
        assert "skew=true" in physical(counted)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
