from __future__ import annotations

import hashlib
import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracebook.fixed_values import KEY_NULL_TOKEN, METRIC_CATALOGUE, TOPIC_KEYWORDS
from tracebook.functions import display, rules, scoring
from tracebook.functions.keys import file_key, parent_code, surrogate_key


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_fixed_lists_have_their_declared_sizes():
    assert len(METRIC_CATALOGUE) == 19
    assert [len(words) for words in TOPIC_KEYWORDS.values()] == [16, 9, 7, 11, 10]


def test_surrogate_key_joins_parts_and_marks_nulls(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y short")
    got = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert got == [md5("a-1"), md5(f"{KEY_NULL_TOKEN}-2")]


def test_parent_code_and_file_key(spark):
    df = spark.createDataFrame([("E1-6.scope_2",), ("S1-9",), ("a.b.c",)], "c string")
    assert [r[0] for r in df.select(parent_code("c")).collect()] == ["E1-6", "S1-9", "a"]
    assert df.select(file_key(F.lit("AB.XX"), F.lit(2024))).first()[0] == "AB.XX-2024"


def expected_confidence(logprob, structural, snippet, language):
    if not structural:
        return 0.0
    value = max(0.0, min(1.0, (logprob + 5.0) / 5.0))
    value = value if snippet else value * 0.5
    value = value if language else value * 0.7
    return round(value, 3)


def test_confidence_equals_binary_rounding(spark):
    random.seed(7)
    cases = [
        (-5.0 * (1.0 - k / 10000.0), True, random.random() < 0.5, random.random() < 0.5)
        for k in range(0, 10001, 3)
    ]
    cases += [(10.0, True, True, True), (-100.0, True, True, True), (-0.1, False, True, True)]
    df = spark.createDataFrame(cases, "l double, s boolean, m boolean, g boolean")
    scored = scoring.with_confidence(df, "score", *[F.col(c) for c in "lsmg"])
    for r in scored.collect():
        assert float(r.score) == expected_confidence(r.l, r.s, r.m, r.g), r


@pytest.mark.parametrize(
    "logprob, structural, snippet, language, route",
    [
        (-0.1, True, True, True, "published"),
        (-0.1, False, True, True, "review"),
        (-0.1, True, False, True, "review"),
        (-2.0, True, True, False, "review"),
        (-5.0, True, True, True, "review"),
        (-0.5, True, True, True, "published"),
    ],
)
def test_scoring_grid(spark, logprob, structural, snippet, language, route):
    df = spark.createDataFrame(
        [(logprob, structural, snippet, language)], "l double, s boolean, m boolean, g boolean"
    )
    scored = scoring.with_confidence(df, "score", *[F.col(c) for c in "lsmg"])
    assert scored.select(scoring.band(F.col("score"))).first()[0] == route


def test_band_at_the_border(spark):
    df = spark.createDataFrame([("0.500",), ("0.790",), ("0.799",), ("0.800",), ("0.810",)], "s string")
    got = df.select(scoring.band(F.col("s").cast("decimal(4,3)"))).collect()
    assert [r[0] for r in got] == ["review"] * 3 + ["published"] * 2


def test_missing_rating_counts_as_half(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (-1.0,)], "r double")
    assert [r[0] for r in df.select(scoring.pseudo_logprob(F.col("r"))).collect()] == [
        -2.5, 0.0, 0.0, -5.0,
    ]


def expected_match(snippet, number, text):
    plain = snippet.replace(",", "").replace(" ", "").lower()
    if number is not None:
        forms = {f"{number:.0f}", f"{number:.1f}", f"{number:.2f}"}
        return any(form.replace(".", "") in plain for form in forms)
    return text is not None and text.lower() in snippet.lower()


def test_snippet_match_against_python_formatting(spark):
    random.seed(11)
    numbers = [0.125, 2.5, 0.5, 1.005, 2.675, 147500.0, 147500.6, -3.0, -0.04, 4.1, 0.0, 99.995]
    numbers += [round(random.uniform(-2000, 2000), random.choice([0, 1, 2, 3])) for _ in range(300)]
    cases = []
    for number in numbers:
        for places in (0, 1, 2):
            shown = f"{abs(number):,.{places}f}"
            cases.append((f"total of {shown} tonnes", number, None))
            cases.append((f"about {shown.replace(',', ' ')}", number, None))
        cases.append(("nothing of the kind", number, None))
    cases += [("The answer is YES.", None, "yes"), ("no answer", None, "yes"), ("x", None, None)]
    df = spark.createDataFrame(cases, "snippet string, number double, word string")
    checked = scoring.with_snippet_match(
        df, "found", F.col("snippet"), F.col("number"), F.col("word")
    )
    for r in checked.collect():
        assert r.found == expected_match(r.snippet, r.number, r.word), r


def test_snippet_match_keeps_dots_unless_lenient(spark):
    df = spark.createDataFrame(
        [("emitted 147.500 t", 147500.0), ("emitted 147 500 t", 147500.0)],
        "snippet string, number double",
    )
    args = (F.col("snippet"), F.col("number"), F.lit(None).cast("string"))
    strict = scoring.with_snippet_match(df, "found", *args)
    lenient = scoring.with_snippet_match(df, "found", *args, strict=False)
    assert [r.found for r in strict.collect()] == [False, False]
    assert [r.found for r in lenient.collect()] == [True, True]


def test_value_missing_from_source(spark):
    cases = [
        ("we used 147,501 MWh", "147500.6", None, False),  # rounds half away, not down
        ("we used 147 500 MWh", "147500.6", None, True),
        ("we used 12.500000 MWh", "12.5", None, False),
        ("we used 13 MWh", "12.5", None, False),
        ("we emitted 9000000000 t", "9000000000", None, False),  # beyond 32 bits
        ("A Plan Exists", None, "plan", False),
        ("A Plan Exists", None, "target", True),
        ("no value", None, None, True),
    ]
    df = spark.createDataFrame(
        [(s, None if n is None else Decimal(n), t, e) for s, n, t, e in cases],
        "s string, n decimal(28,6), t string, e boolean",
    )
    failing = scoring.value_missing_from_source(F.col("s"), F.col("n"), F.col("t"))
    assert all(r.f == r.e for r in df.select("*", failing.alias("f")).collect())


GOOD = {
    "company_ticker": "AB.XX", "fiscal_year": 2024, "esrs_topic": "E1", "esrs_disclosure": "E1-6",
    "metric_name": "Some metric", "value_numeric": 5.0, "value_text": None,
    "confidence_score": 0.5, "source_page": 1, "source_snippet": "a quote of 5 units in the text",
    "language": "en", "extraction_model": "mistral-large-latest",
}
SCHEMA = (
    "company_ticker string, fiscal_year int, esrs_topic string, esrs_disclosure string, "
    "metric_name string, value_numeric double, value_text string, confidence_score double, "
    "source_page int, source_snippet string, language string, extraction_model string"
)


@pytest.mark.parametrize(
    "change, broken",
    [
        ({}, []),
        ({"value_numeric": None, "value_text": "Yes"}, []),
        ({"value_text": "Yes"}, ["exactly_one_value"]),
        ({"value_numeric": None}, ["exactly_one_value"]),
        ({"source_snippet": "too short"}, ["source_snippet_length"]),
        ({"source_snippet": "  " * 12}, ["source_snippet_blank"]),
        ({"source_snippet": "x" * 501}, ["source_snippet_length"]),
        ({"confidence_score": 1.5}, ["confidence_score_range"]),
        ({"esrs_topic": "E9"}, ["esrs_topic_value"]),
        ({"fiscal_year": 2019}, ["fiscal_year_range"]),
        ({"fiscal_year": 2031}, ["fiscal_year_range"]),
        ({"language": None, "source_page": 0}, ["language_value", "source_page_min"]),
        ({"company_ticker": "A", "metric_name": "ab"}, ["company_ticker_length", "metric_name_length"]),
    ],
)
def test_record_rules(spark, change, broken):
    df = spark.createDataFrame([{**GOOD, **change}], SCHEMA)
    checked = rules.validate(df, rules.record_rules()).first()
    assert sorted(checked.violations) == sorted(broken)


def test_landing_limits(spark):
    df = spark.createDataFrame([("x" * 501, "u"), (None, "u" * 51), ("x", None)], "value_text string, unit string")
    got = [r.violations for r in rules.validate(df, rules.landing_limits()).collect()]
    assert got == [["value_text_limit"], ["unit_limit"], []]


def test_registry_rules(spark):
    schema = (
        "ticker string, name string, sector string, country string, ir_page_url string, "
        "known_report_url string, language string"
    )
    good = ("AB.XX", "Abc", "Energy", "FR", "https://ab.example/ir", None, "fr")
    bad = ("A", "Abc", "Energy", "fr", "ftp://ab.example", "nowhere", "de")
    valid, invalid = rules.split_valid(
        spark.createDataFrame([good, bad], schema), rules.registry_rules()
    )
    assert [r.ticker for r in valid.collect()] == ["AB.XX"]
    assert sorted(invalid.first().violations) == [
        "country_code", "ir_page_url_http", "known_report_url_http", "language_code",
        "ticker_length",
    ]


def test_display_forms(spark):
    df = spark.createDataFrame(
        [
            (1234567.5, None, "t"), (999.5, None, None), (4.0, None, ""), (-1000.0, None, "m3"),
            (None, "Yes", "boolean"), (None, None, None),
        ],
        "n double, t string, u string",
    )
    shown = df.select(display.metric_value(F.col("n"), F.col("t"), F.col("u"))).collect()
    assert [r[0] for r in shown] == [
        "1 234 567,5 t", "999.5", "4", "-1 000 m3", "Yes", "—",
    ]
    one = spark.createDataFrame(
        [("x" * 101, "E1", "claude-sonnet-4-6", datetime(2024, 5, 6, 7))],
        "t string, topic string, model string, ts timestamp",
    )
    got = one.select(
        display.preview(F.col("t")),
        display.topic_label(F.col("topic")),
        display.topic_label(F.lit("Z9")),
        display.model_label(F.col("model")),
        display.model_label(F.lit("other")),
        display.iso_date(F.col("ts")),
        display.percent(F.lit("0.365").cast("decimal(4,3)")),
        display.eur_millions(F.lit(3870)),
    ).first()
    assert tuple(got) == (
        "x" * 100 + "…", "E1 — Climate change", None, "claude", "mistral", "2024-05-06", "36.5%",
        "€3,870M",
    )
    assert rows(one.select(display.preview(F.lit("short")))) == [("short",)]


def test_exact_units_of_doubles_of_all_sizes(spark):
    import random
    from decimal import ROUND_HALF_EVEN, Decimal, localcontext

    rng = random.Random(3)
    values = [0.0, 0.4125, 0.5, 1.5, 2.5, 0.125, 0.375, 1e11 + 0.5, 1e11 + 1.5, 1e12 + 0.5, 1e12 + 0.125, 1e15 + 0.5,
              1e15 + 1.5, 2.0**53, 2.0**53 + 2, 1e16, 1.2345678901234567e20, 1e22, 1e30, 2.0**80 + 2.0**40]
    values += [rng.random() * 10.0 ** rng.randrange(-3, 25) for _ in range(300)]
    values += [rng.randrange(2**40) * 2.0**-k for k in range(12) for _ in range(20)]
    df = spark.createDataFrame([(v,) for v in [*values, 1e36, None]], "x double")
    got = scoring.with_exact_units(df, {f"u{d}": ("x", d) for d in (0, 1, 2, 3)}).collect()
    with localcontext() as context:
        context.prec = 400
        for row in got[: len(values)]:
            for d in (0, 1, 2, 3):
                expected = (Decimal(row.x) * 10**d).quantize(Decimal(1), ROUND_HALF_EVEN)
                assert row[f"u{d}"] == expected, (row.x, d)
    assert [r.u0 for r in got[-2:]] == [None, None]
