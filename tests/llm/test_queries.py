from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import connect, differences  # noqa: E402

import corpus_pipeline  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tracebook.llm import queries as llm  # noqa: E402
from tracebook.llm import simhash  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_query_matches_its_sql(spark, name):
    ours = llm.QUERIES[name](spark, SMALL).toPandas()
    theirs = connect(SMALL).execute(llm.SQL[name]).df()
    assert differences(ours, theirs) == []


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in llm.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*llm.QUERIES, "pipeline"} <= queries().keys() and llm.SQL.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", ["op3_line_frequency_rules", "op8_license_scan", "op12_source_mix"])
def test_native_queries_run_no_python(spark, name):
    plan = llm.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_stages_of_the_pipeline(docs, spark, tmp_path):
    """Toxic documents, near copies and leaks go, secrets are masked, clean documents stay."""
    import random

    rng = random.Random(1)
    words = ["".join(rng.choices("abcdenorst", k=rng.randrange(3, 8))) for _ in range(3000)]

    def text(n=80):
        return " ".join(rng.choices(words, k=n))

    rows = [(i, text()) for i in range(200)]
    toxic = [(1000 + i, f"{text(30)} idiot scum moron {text(20)} idiot") for i in range(60)]
    copies = [(2000 + i, rows[i][1]) for i in range(20)] + [(2100 + i, rows[i][1] + " tail") for i in range(20)]
    items = [text(40) for _ in range(5)]
    leaks = [(3000 + i, f"{text(40)} {item} {text(10)}") for i, item in enumerate(items)]
    secret = "".join(rng.choices("0123456789abcdef", k=40))
    secrets = [(4000, f'{text(30)} token = "{secret}" {text(30)}'), (None, text())]
    table = docs(*rows, *toxic, *copies, *leaks, *secrets)
    folder = str(tmp_path)
    table.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in rows] + [(i, 0, 1) for i, _ in toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    current, kept = corpus_pipeline.documents(spark.read.parquet(f"{folder}/documents.parquet")), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, current, folder).write.parquet(f"{folder}/stage{number}")
        current = spark.read.parquet(f"{folder}/stage{number}")
        assert current.columns == table.columns
        kept.append({r.doc_id for r in current.select("doc_id").collect()})
    clean = {i for i, _ in rows}
    assert kept[0].isdisjoint({i for i, _ in toxic}) and len(clean - kept[0]) <= 4
    # copies whose fingerprint is two bits or fewer from their original's go; one word more can flip more bits
    prints = {r.doc_id: r.code % 2**64 for r in simhash.fingerprints(table).collect()}
    linked = {i for i, _ in copies if (prints[i] ^ prints[i % 100]).bit_count() <= 2}
    assert linked >= {2000 + i for i in range(20)} and len(linked) > 22
    assert kept[1].isdisjoint(linked) and kept[0] & clean == kept[1] & clean
    assert kept[2] == kept[1] - {i for i, _ in leaks}
    assert kept[3] == kept[2]
    left = {r.doc_id: r for r in current.collect()}
    assert secret not in left[4000].text and "secret removed" in left[4000].text
    assert left[4000].n_chars == len(left[4000].text)
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept[3]
