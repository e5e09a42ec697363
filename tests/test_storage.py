from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_star import landing, lists
from tracebook.operators.picks import latest_per_key
from tracebook.plans.disclosures import build, refresh
from tracebook.schemas import COMPANIES, PERIODS, RAW
from tracebook.sources import scans, sinks
from tracebook.streaming import landing as stream


def record(name, hour=1, score=0.9, snippet="a quoted text with the figure 5 in it", **change):
    return {
        "company_ticker": "AA.X", "fiscal_year": 2024, "esrs_topic": "E1", "esrs_disclosure": "E1-6",
        "metric_name": name, "value_numeric": 5.0, "value_text": None, "unit": "t",
        "confidence_score": score, "source_citation": {"page": 3, "snippet": snippet},
        "language": "en", "extraction_model": "claude-sonnet-4-6",
        "extraction_timestamp": f"2024-05-01T{hour:02d}:00:00Z", **change,
    }


def test_typed_reference_lists(spark, tmp_path):
    (tmp_path / "companies.csv").write_text(
        "ticker,name,sector,country,ir_page_url,language\nAA.X,\"Alpha, Inc\",Energy,FR,https://a.example,fr\n")
    (tmp_path / "periods.csv").write_text(
        "fiscal_year,period_start,period_end,reporting_basis\n2024,2024-01-01,2024-12-31,basis\n")
    companies = scans.reference_list(spark, str(tmp_path / "companies.csv"), COMPANIES)
    assert companies.first().name == "Alpha, Inc"
    periods = scans.reference_list(spark, str(tmp_path / "periods.csv"), PERIODS)
    assert [t for _, t in periods.dtypes] == ["smallint", "date", "date", "string"]
    assert periods.count() == 1
    assert scans.metric_catalogue(spark).count() == 19
    assert rows(scans.metric_catalogue(spark).where("esrs_topic = 'E3'"), "esrs_disclosure") == [("E3-4",)] * 2


def test_registry_is_validated_as_a_whole(spark, tmp_path):
    head = "ticker,name,sector,country,ir_page_url,known_report_url,language\n"
    good = tmp_path / "good.csv"
    good.write_text(head + "AA.X,Alpha,Energy,FR,https://a.example,,fr\n")
    assert scans.registry(spark, str(good)).first().known_report_url is None
    bad = tmp_path / "bad.csv"
    bad.write_text(head + "AA.X,Alpha,Energy,FR,https://a.example,,de\n")
    with pytest.raises(ValueError, match="language_code"):
        scans.registry(spark, str(bad))
    empty = tmp_path / "empty.csv"
    empty.write_text(head)
    with pytest.raises(ValueError, match="1 to 200"):
        scans.registry(spark, str(empty))


def test_archive_round_trip(spark, tmp_path):
    folder = tmp_path / "archive"
    folder.mkdir()
    (folder / "b.json").write_text(json.dumps([record("one"), record("two", score=1.5)]))
    (folder / "a.json").write_text(json.dumps([record("three", value_numeric=None, value_text="Yes")]))
    valid, invalid = scans.archive_rows(spark, str(folder))
    assert valid.schema.fieldNames() == RAW.fieldNames()
    assert rows(valid, "metric_name", "source_page", "value_text") == [("one", 3, None), ("three", 3, "Yes")]
    assert [(r.metric_name, r.violations) for r in invalid.collect()] == [("two", ["confidence_score_range"])]
    records = scans.record_archive(spark, str(folder))
    sinks.write_archive(records, str(tmp_path / "out"))
    assert (tmp_path / "out" / "company_ticker=AA.X" / "fiscal_year=2024").is_dir()
    assert rows(scans.archive_lines(spark, str(tmp_path / "out"))) == rows(records)


def test_append_counts_and_reload(spark, tmp_path):
    table = str(tmp_path / "raw")
    df = landing(spark)
    assert sinks.append_rows(df, table) == 9
    assert sinks.append_rows(df.where("company_ticker = 'AA.X'"), table) == 7
    assert scans.raw_table(spark, table).count() == 16
    assert sinks.append_rows(df.where("false"), table) == 0
    assert rows(latest_per_key(scans.raw_table(spark, table))) == rows(latest_per_key(df))
    assert sinks.reload_rows(df, table) == 9
    assert rows(scans.raw_table(spark, table)) == rows(df)


def test_layers_tables_and_views(spark, tmp_path):
    sinks.create_layers(spark, RAW)
    sinks.create_layers(spark, RAW)
    assert spark.table("raw.disclosure_extracted").count() == 0
    assert dict(spark.table("raw.disclosure_extracted").dtypes)["value_numeric"] == "decimal(28,6)"
    df = landing(spark)
    assert sinks.as_view(df, "staged").count() == 9
    assert sinks.as_table(df, "marts.one").count() == 9
    assert sinks.as_table(df.where("fiscal_year = 2023"), "marts.one").count() == 1
    sinks.write_clustered(df, str(tmp_path / "clustered"))
    assert spark.read.schema(RAW).parquet(str(tmp_path / "clustered")).count() == 9
    documents = spark.createDataFrame([("AA.X", 0, 1, "[]")], "company_ticker string, part long, item_count long, items string")
    sinks.write_documents(documents, spark.createDataFrame([("{}",)], "header string"), str(tmp_path / "snap"))
    assert spark.read.json(str(tmp_path / "snap" / "companies")).count() == 1


def test_refresh_stores_the_star(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS refreshed")
    lazy = build(landing(spark), *lists(spark))
    for _ in range(2):  # a second refresh replaces the first
        stored = refresh(landing(spark), *lists(spark), "refreshed")
    for part in ("companies", "metrics", "periods", "fact", "published", "review"):
        assert rows(getattr(stored, part)) == rows(getattr(lazy, part)), part
    assert rows(spark.table("refreshed.mart_disclosure_published")) == rows(lazy.published)
    assert spark.table("stg_disclosure").count() == 7


def test_refresh_that_fails_leaves_the_old_tables(spark, monkeypatch):
    from tracebook.operators import star
    from tracebook.plans.disclosures import STORED

    spark.sql("CREATE DATABASE IF NOT EXISTS versioned")
    sinks.create_table(spark, "versioned.dim_period", STORED["dim_period"])  # an empty, declared table
    df = landing(spark)
    refresh(df, *lists(spark), "versioned")

    def seen():
        return {name: rows(spark.table(f"versioned.{name}")) for name in STORED}

    before = seen()
    assert all(spark.catalog.getTable(f"versioned.{name}").tableType == "VIEW" for name in STORED)
    assert {f.name: f.dataType for f in spark.table("versioned.mart_disclosure_review_queue").schema} == {
        f.name: f.dataType for f in STORED["mart_disclosure_review_queue"]}
    changed = df.withColumn("confidence_score", F.lit("0.1").cast("decimal(4,3)"))

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(star, "review_mart", broken)  # after dimensions, fact and the published mart
        with pytest.raises(RuntimeError):
            refresh(changed, *lists(spark), "versioned")
    assert seen() == before
    assert len(sinks.versions(spark, "versioned", "fact_disclosure")) == 2
    # run again, it comes through; the versions left are this one and one before
    refresh(changed, *lists(spark), "versioned")
    assert {r.confidence_score for r in spark.table("versioned.fact_disclosure").collect()} != {
        r[7] for r in before["fact_disclosure"]}
    refresh(df, *lists(spark), "versioned")
    assert seen() == before
    for name in STORED:
        assert len(sinks.versions(spark, "versioned", name)) == 2, name
    with pytest.raises(ValueError, match="has no stg_disclosure"):
        sinks.switch_version(spark, "versioned", tuple(STORED), "never")
    assert seen() == before


def test_landed_file_admission(spark, tmp_path):
    for name, body in {"AA.X-2024": b"%PDF-1.7 x", "BB.X-2024": b"<html>", "CC.X-2024": b"",
                       "DD.X-2024": b"%PDF-old", "EE.X-2024": b"%PDF-again"}.items():
        (tmp_path / f"{name}.pdf").write_bytes(body)
    files = scans.landed_files(spark, str(tmp_path))
    landed = spark.createDataFrame([("DD.X-2024", 9), ("EE.X-2024", 0)], "file_key string, length long")
    admitted = scans.admitted_files(files.drop("length"), landed, F.col("content"))
    assert rows(admitted, "file_key") == [("AA.X-2024",), ("EE.X-2024",)]


def test_stream_lands_in_any_order_and_latest_wins(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()

    def run():
        query = stream.land_stream(
            stream.archive_stream(spark, str(source), 1), table, str(tmp_path / "rejects"),
            str(tmp_path / "checkpoint"))
        query.awaitTermination()
        assert query.exception() is None

    (source / "1.json").write_text(json.dumps([record("one", hour=9, score=0.9)]))
    (source / "2.json").write_text(json.dumps([record("two"), record("bad", snippet="short")]))
    run()
    (source / "3.json").write_text(json.dumps([record("one", hour=3, score=0.1)]))  # late and older
    (source / "4.json").write_text(json.dumps([record("two", hour=4, score=0.2)]))
    run()
    assert stream.landed_rows(spark, table).count() == 4
    latest = {r.metric_name: (float(r.confidence_score), r.extraction_timestamp)
              for r in stream.latest_landed(spark, table).collect()}
    assert latest["one"][0] == 0.9 and latest["two"] == (0.2, datetime(2024, 5, 1, 4))
    rejects = spark.read.parquet(str(tmp_path / "rejects"))
    assert rows(rejects, "metric_name") == [("bad",)]
    run()
    assert stream.landed_rows(spark, table).count() == 4


def test_merge_rewrites_only_the_buckets_of_the_batch(spark, tmp_path):
    source, state, plain = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "table")
    source.mkdir()

    def run():
        query = stream.land_stream(
            stream.archive_stream(spark, str(source), 1), plain, str(tmp_path / "rejects"),
            str(tmp_path / "checkpoint"), state, buckets=16)
        query.awaitTermination()
        assert query.exception() is None

    def files():
        return {str(p) for p in (tmp_path / "state").glob("bucket=*/*.parquet")}

    (source / "1.json").write_text(json.dumps([record(f"metric {i}", hour=5) for i in range(60)]))
    run()
    before = files()
    assert len({f.split("/")[-2] for f in before}) > 10
    (source / "2.json").write_text(json.dumps([record("metric 7", hour=9, score=0.5), record("metric 8", hour=2)]))
    run()
    # two keys: at most two buckets have new files, all others are the same files as before
    gone = {f.split("/")[-2] for f in before - files()}
    assert 1 <= len(gone) <= 2
    assert rows(stream.latest_state(spark, state)) == rows(stream.latest_landed(spark, plain))
    again = files()
    stream.merge_latest(stream.landed_rows(spark, plain).where("metric_name = 'metric 8'"), state, 16)  # once more
    assert rows(stream.latest_state(spark, state)) == rows(stream.latest_landed(spark, plain))
    assert len(again - files()) <= 2
    stream.merge_latest(stream.landed_rows(spark, plain).limit(0), state, 16)
    # the other way round
    turned = str(tmp_path / "turned")
    landed = stream.landed_rows(spark, plain)
    for hour in (9, 5, 2):
        stream.merge_latest(landed.where(F.hour("extraction_timestamp") == hour), turned, 16)
    assert rows(stream.latest_state(spark, turned)) == rows(stream.latest_landed(spark, plain))
