"""SQL for the disclosure pipeline over the test tables."""

from __future__ import annotations

from tracebook.fixed_values import TOPICS
from tracebook.plans.disclosure_bindings import FIRST_MODEL, SECOND_MODEL, TOPIC_OF
from tracebook.plans.oracles import EVENT_SCORE, ORACLES, three_decimals

KEY = "company_ticker, fiscal_year, esrs_disclosure, metric_name, extraction_model"
TOPIC = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{t}'" for e, t in TOPIC_OF.items()) + " END"
RECORDS = f"""(
    SELECT *, 'C' || user_id AS company_ticker,
           CASE WHEN event_type = 'signup' THEN 2023 ELSE 2024 END AS fiscal_year,
           {TOPIC} AS esrs_topic, {TOPIC} || '-' || (k // 40 + 1) AS esrs_disclosure,
           'Metric ' || (k // 10) AS metric_name, CAST(value AS DECIMAL(28,6)) AS value_numeric,
           'u' AS unit, {EVENT_SCORE} AS confidence_score, k + 1 AS source_page,
           'Props reported: ' || props AS source_snippet, 'en' AS language,
           CASE WHEN value < 40 THEN '{FIRST_MODEL}' ELSE '{SECOND_MODEL}' END AS extraction_model,
           ts AS extraction_timestamp
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events))"""
WITH = f"""
WITH raw AS (SELECT * FROM {RECORDS}),
staged AS (
    SELECT * FROM raw QUALIFY row_number() OVER (
        PARTITION BY {KEY} ORDER BY extraction_timestamp DESC) = 1),
companies AS (
    SELECT md5('C' || c_custkey) AS company_id, 'C' || c_custkey AS ticker, c_name AS name,
           c_mktsegment AS sector, 'FR' AS country, 'en' AS language FROM customer),
catalogue AS (
    SELECT DISTINCT esrs_topic, esrs_disclosure, metric_name, unit FROM raw WHERE value_numeric > 200),
metrics AS (
    SELECT md5(esrs_disclosure || '-' || metric_name) AS metric_id, *, is_in_catalog AS mandatory_flag
    FROM (SELECT *, true AS is_in_catalog FROM catalogue
          UNION ALL
          SELECT DISTINCT esrs_topic, esrs_disclosure, metric_name, unit, false
          FROM staged s WHERE NOT EXISTS (
              SELECT 1 FROM catalogue c WHERE c.esrs_disclosure = s.esrs_disclosure
                                          AND c.metric_name = s.metric_name))),
periods AS (SELECT md5('2024') AS period_id, 2024 AS fiscal_year),
fact AS (
    SELECT md5(concat_ws('-', s.company_ticker, s.fiscal_year, s.esrs_disclosure, s.metric_name,
                         s.extraction_model)) AS disclosure_id,
           c.company_id, m.metric_id, p.period_id, s.* EXCLUDE (esrs_topic), m.esrs_topic,
           c.name AS company_name, c.sector, c.country
    FROM staged s JOIN companies c ON c.ticker = s.company_ticker
    JOIN metrics m ON m.esrs_disclosure = s.esrs_disclosure AND m.metric_name = s.metric_name
    JOIN periods p ON p.fiscal_year = s.fiscal_year)"""
MART = """disclosure_id, company_ticker, company_name, sector, country, esrs_topic, esrs_disclosure,
       metric_name, fiscal_year, CAST(value_numeric AS DOUBLE) AS value_numeric, unit,
       CAST(confidence_score AS DOUBLE) AS confidence_score, source_page, source_snippet, language,
       extraction_model, strftime(extraction_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS extraction_timestamp"""

ORACLES["disclosures_published"] = f"{WITH} SELECT {MART} FROM fact WHERE confidence_score >= 0.8"
ORACLES["disclosures_review"] = (
    f"{WITH} SELECT {MART}, false AS human_approved FROM fact WHERE confidence_score < 0.8"
)
ORACLES["disclosure_metrics"] = f"{WITH} SELECT * FROM metrics"

# ---- the declared checks, as (table, check name, failing rows) ----

_CHECKS: list[tuple[str, str, str]] = []
_SOURCES = {
    "raw": "raw", "staging": "staged", "dim_company": "companies", "dim_metric": "metrics",
    "dim_period": "periods", "fact": "fact",
    "published": "(SELECT * FROM fact WHERE confidence_score >= 0.8)",
    "review": "(SELECT *, false AS human_approved FROM fact WHERE confidence_score < 0.8)",
}


def _rows(name: str, check: str, condition: str) -> None:
    _CHECKS.append((name, check, f"SELECT count(*) FROM {_SOURCES[name]} WHERE {condition}"))


def _not_null(name: str, *columns: str) -> None:
    for column in columns:
        _rows(name, f"not_null({column})", f"{column} IS NULL")


def _values(name: str, column: str, values: str) -> None:
    _rows(name, f"accepted_values({column})", f"{column} NOT IN ({values})")


def _unique(name: str, columns: str) -> None:
    repeated = f"SELECT 1 FROM {_SOURCES[name]} GROUP BY {columns} HAVING count(*) > 1"
    _CHECKS.append((name, f"unique({columns})", f"SELECT count(*) FROM ({repeated})"))


_TOPICS = "'E1', 'E2', 'E3', 'S1', 'G1'"
_MODELS = f"'{FIRST_MODEL}', '{SECOND_MODEL}'"
_not_null(
    "raw", "company_ticker", "fiscal_year", "esrs_topic", "esrs_disclosure", "confidence_score",
    "source_page", "source_snippet", "language", "extraction_model", "extraction_timestamp",
)
_values("raw", "esrs_topic", _TOPICS)
_values("raw", "language", "'fr', 'en'")
_values("raw", "extraction_model", _MODELS)
_not_null(
    "staging", "company_ticker", "fiscal_year", "esrs_disclosure", "extraction_model",
    "confidence_score",
)
_values("staging", "extraction_model", _MODELS)
_unique("staging", KEY)
for _table, _id, _other in (
    ("dim_company", "company_id", "ticker"), ("dim_period", "period_id", "fiscal_year"),
):
    _unique(_table, _id)
    _not_null(_table, _id, _other)
    _unique(_table, _other)
_values("dim_company", "country", "'FR'")
_values("dim_company", "language", "'fr', 'en'")
_unique("dim_metric", "metric_id")
_not_null("dim_metric", "metric_id", "esrs_disclosure")
_values("dim_metric", "esrs_topic", _TOPICS)
_unique("fact", "disclosure_id")
_not_null(
    "fact", "disclosure_id", "company_id", "metric_id", "period_id", "confidence_score",
    "source_snippet",
)
for _id, _parent in (("company_id", "companies"), ("metric_id", "metrics"), ("period_id", "periods")):
    _rows("fact", f"relationships({_id})", f"{_id} NOT IN (SELECT {_id} FROM {_parent})")
_rows("fact", "score_range", "NOT (confidence_score BETWEEN 0 AND 1)")
_rows("fact", "unit_interval(confidence_score)", "confidence_score < 0 OR confidence_score > 1")
_rows(
    "fact",
    "value_in_source",
    "len(list_filter(["
    "{'form': printf('%.0f', trunc(value_numeric::DOUBLE + 0.5)), 'place': translate(source_snippet, ', ', '')}, "
    "{'form': value_numeric::VARCHAR, 'place': source_snippet}], "
    "lambda a: contains(a.place, a.form))) = 0",
)
for _table in ("published", "review"):
    _unique(_table, "disclosure_id")
    _not_null(_table, "disclosure_id")
_rows("published", "published_rule", "NOT (confidence_score >= 0.8)")
_values("review", "human_approved", "false")
_CHECKS.append(
    (
        "marts",
        "routes_disjoint",
        f"SELECT count(*) FROM (SELECT disclosure_id FROM {_SOURCES['published']} "
        f"INTERSECT SELECT disclosure_id FROM {_SOURCES['review']})",
    )
)
ORACLES["disclosure_checks"] = (
    WITH
    + " SELECT *, failures = 0 AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{check}' AS check_name, ({sql}) AS failures"
        for name, check, sql in _CHECKS
    )
    + ")"
)

SNAPSHOT = f"""
{WITH},
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY company_ticker ORDER BY
        esrs_topic, esrs_disclosure, metric_name, extraction_model) - 1 AS number
    FROM staged WHERE fiscal_year = 2024)
SELECT company_ticker, number // PART_SIZE AS part, count(*) AS item_count,
    CAST(to_json(list({{'id': company_ticker || '-' || number, 'esrsTopic': esrs_topic,
        'esrsDisclosure': esrs_disclosure, 'metricName': metric_name,
        'valueNumeric': CAST(value_numeric AS DOUBLE), 'valueText': CAST(NULL AS VARCHAR), 'unit': unit,
        'confidenceScore': CAST(confidence_score AS DOUBLE), 'sourcePage': source_page,
        'sourceSnippet': source_snippet, 'language': language,
        'extractionModel': extraction_model}} ORDER BY number)) AS VARCHAR) AS items
FROM numbered GROUP BY ALL"""
ORACLES["disclosure_snapshot"] = SNAPSHOT.replace("PART_SIZE", "10000")
ORACLES["snapshot_parts"] = SNAPSHOT.replace("PART_SIZE", "5")

ORACLES["disclosures_reviewed"] = f"""
{WITH},
decisions AS (
    SELECT md5(concat_ws('-', company_ticker, fiscal_year, esrs_disclosure, metric_name, extraction_model))
               AS disclosure_id, source_page % 2 = 0 AS approved, extraction_timestamp AS decided_at
    FROM raw WHERE source_page % 3 = 0),
decided AS (
    SELECT * FROM decisions QUALIFY row_number() OVER (
        PARTITION BY disclosure_id ORDER BY decided_at DESC, approved) = 1),
routed AS (
    SELECT fact.*, CASE WHEN fact.esrs_topic = 'E2' THEN 'Word ' || source_page END AS value_text, approved,
           CASE WHEN approved OR (approved IS NULL AND confidence_score >= 0.8) THEN 'published' ELSE 'review' END AS route
    FROM fact LEFT JOIN decided USING (disclosure_id))
SELECT {MART}, value_text, CASE WHEN route = 'review' THEN coalesce(approved, false) END AS human_approved, route
FROM routed"""

ORACLES["flattened_records"] = f"""
SELECT event_id, company_ticker, source_page - 5 AS source_page,
    CASE WHEN event_type = 'view' OR event_id % 10 IN (5, 6) THEN -1
         ELSE CAST(value_numeric AS DOUBLE) END AS value_numeric,
    array_to_string(list_filter([
        CASE WHEN length(company_ticker) NOT BETWEEN 2 AND 10 THEN 'company_ticker_length' END,
        CASE WHEN event_type = 'error' THEN 'exactly_one_value' END,
        CASE WHEN event_id % 10 IN (3, 4) THEN 'confidence_score_range' END,
        CASE WHEN source_page - 5 < 1 THEN 'source_page_min' END,
        CASE WHEN k >= 90 OR length(source_snippet) NOT BETWEEN 20 AND 500
             THEN 'source_snippet_length' END,
        CASE WHEN k >= 90 THEN 'source_snippet_blank' END,
        CASE WHEN event_type <> 'view' AND event_id % 10 IN (5, 6) THEN 'value_numeric_fits' END],
        lambda x: x IS NOT NULL), ',') AS violations
FROM {RECORDS}"""

ORACLES["extracted_records"] = f"""
WITH chosen AS (
    SELECT *, event_type = 'click' AS second,
           CASE WHEN event_type = 'click' THEN value ELSE CAST(k AS DOUBLE) END AS number,
           replace('Props reported in the text: ' || k, ' ', '') AS plain
    FROM {RECORDS} WHERE event_type <> 'click' OR k < 80),
based AS (
    SELECT *, ((-5.0::DOUBLE * (1.0::DOUBLE - k / 100.0::DOUBLE)) + 5.0::DOUBLE) / 5.0::DOUBLE
        * CASE WHEN contains(plain, printf('%.0f', number))
                 OR contains(plain, replace(printf('%.1f', number), '.', ''))
                 OR contains(plain, replace(printf('%.2f', number), '.', ''))
               THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS x
    FROM chosen)
SELECT 'EV' || event_id AS company_ticker, esrs_topic, esrs_disclosure, metric_name,
       7 AS source_page,
       CASE WHEN second THEN '{SECOND_MODEL}' ELSE '{FIRST_MODEL}' END AS extraction_model,
       number AS value_numeric, {three_decimals("x")} AS confidence_score
FROM based"""

ORACLES["attempt_ledger"] = f"""
WITH tried AS (
    SELECT esrs_topic AS topic,
           CASE WHEN event_type <> 'click' THEN '{FIRST_MODEL}' WHEN k < 80 THEN '{SECOND_MODEL}' END AS model
    FROM {RECORDS}),
ended AS (
    SELECT topic, model, CASE WHEN model IS NULL THEN
           '{FIRST_MODEL}: payload refused; {SECOND_MODEL}: payload refused' END AS error FROM tried
    UNION ALL
    SELECT t.topic, NULL, 'no attempt' FROM {RECORDS}
    JOIN (SELECT unnest({list(TOPICS)}) AS topic) t ON t.topic <> esrs_topic),
counted AS (
    SELECT CASE WHEN GROUPING(topic) = 1 THEN 3 WHEN GROUPING(model) = 1 THEN 1 ELSE 0 END AS level,
           topic, model, error, count(*) AS attempts, count(error) AS failed
    FROM ended GROUP BY GROUPING SETS ((topic, model, error), (topic), ()))
SELECT *, failed > attempts // 2 AS gate_broken FROM counted"""

ORACLES["resolved_urls"] = """
SELECT CAST(page_id AS VARCHAR) AS ticker,
       CASE WHEN starts_with(url, 'https://') THEN url
            ELSE 'no report URL known for ' || page_id END AS outcome,
       page_id || '-2024' || CASE WHEN starts_with(url, 'https://') THEN '.pdf' ELSE '' END AS target
FROM pages"""

ORACLES["nation_lookup"] = """
SELECT n_name, s_suppkey, s_name FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey
WHERE n_name = 'NATION_3'"""
