"""SQL for DuckDB that states, independently of Spark, what each query must return."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tracebook.fixed_values import METRIC_CATALOGUE
from tracebook.plans.bindings import BUDGET, CHAT_TOPICS, LANGUAGE_ORDER, LINE_TOPICS, MONTH

ORACLES: dict[str, str] = {}


def text(value: str) -> str:
    """A string literal; line breaks as chr(10)."""
    lines = [f"'{line}'" for line in value.replace("'", "''").split("\n")]
    return "(" + " || chr(10) || ".join(lines) + ")"


def latest(source: str, keys: str, order: str, columns: str = "*") -> str:
    return (
        f"(SELECT {columns} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"
    )


def three_decimals(x: str) -> str:
    """A double as it is printed with three decimals, which rounds its exact binary value."""
    return f"CAST(printf('%.3f', {x}) AS DOUBLE)"


LATEST_EVENTS = latest("events", "user_id, event_type", "ts DESC, event_id DESC")
EVENT_SCORE = "CAST(round(CAST(least(value, 100.0) / 100 AS DECIMAL(18,6)), 3) AS DECIMAL(4,3))"
LATEST_LINES = latest(
    "lineitem",
    "l_orderkey, l_linenumber",
    "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
    "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC",
)
JUDGED = """(
    SELECT doc_id, lang, source, toxic, quality = 1 AS approved,
           CAST(floor(least(n_chars, 2000) / 2.0 + 0.5) / 1000 AS DECIMAL(4,3)) AS score
    FROM documents LEFT JOIN labels USING (doc_id))"""
PUBLISHED = "(score >= 0.8 OR coalesce(approved, false))"
REVIEW = "(score < 0.8 AND NOT coalesce(approved, false))"
URGENT = "o_orderpriority = '1-URGENT'"
CHAT = "(SELECT conv_id AS report_id, CAST(turn + 1 AS INTEGER) AS page, text FROM conversations)"
LINES = """(
    SELECT doc_id AS report_id, page, line AS text FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS page FROM documents))"""

ORACLES["latest_event_per_key"] = f"""
SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value, props
FROM {LATEST_EVENTS}"""

ORACLES["latest_line_per_key"] = f"""
SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM {LATEST_LINES}"""

ORACLES["route_summary"] = f"""
SELECT total, published, total - published AS review,
       CAST(round_even(published * 100.0 / greatest(total, 1), 0) AS BIGINT) AS published_pct,
       CAST(round_even((total - published) * 100.0 / greatest(total, 1), 0) AS BIGINT) AS review_pct
FROM (SELECT count(*) AS total, count(*) FILTER ({EVENT_SCORE} >= 0.8) AS published
      FROM {LATEST_EVENTS})"""

ORACLES["band_label"] = f"""
SELECT user_id, event_type,
       CASE WHEN {EVENT_SCORE} >= 0.8 THEN 'published' ELSE 'review' END AS band
FROM {LATEST_EVENTS}"""

ORACLES["published_docs"] = f"""
SELECT doc_id AS document_id, lang, source, CAST(score AS DOUBLE) AS score
FROM {JUDGED} WHERE {PUBLISHED}"""

ORACLES["review_docs"] = f"""
SELECT doc_id AS document_id, lang, source, CAST(score AS DOUBLE) AS score,
       coalesce(approved, false) AS human_approved
FROM {JUDGED} WHERE {REVIEW}"""

ORACLES["rejected_wins_docs"] = f"""
SELECT CASE WHEN approved THEN 'published' WHEN approved = false THEN 'review'
            WHEN score >= 0.8 THEN 'published' ELSE 'review' END AS route, count(*) AS docs
FROM {JUDGED} GROUP BY 1"""

ORACLES["routes_disjoint"] = f"""
SELECT 'published_review' AS pair, doc_id FROM (
    SELECT doc_id FROM {JUDGED} WHERE {PUBLISHED}
    INTERSECT SELECT doc_id FROM {JUDGED} WHERE {REVIEW})
UNION ALL
SELECT 'published_toxic' AS pair, doc_id FROM (
    SELECT doc_id FROM {JUDGED} WHERE {PUBLISHED}
    INTERSECT SELECT doc_id FROM {JUDGED} WHERE toxic = 1)"""

# ---- star ----

SUPPLIER_DIM = "(SELECT md5(CAST(s_suppkey AS VARCHAR)) AS supplier_id, * FROM supplier)"
PART_DIM = """(
    WITH seeded AS (
        SELECT DISTINCT p_brand, p_name, p_type, true AS is_in_catalog
        FROM part WHERE p_type = 'PROMO'),
    discovered AS (
        SELECT p_brand, p_name, min(p_type) AS p_type, false AS is_in_catalog FROM part
        WHERE NOT EXISTS (SELECT 1 FROM seeded
                          WHERE seeded.p_brand = part.p_brand AND seeded.p_name = part.p_name)
        GROUP BY p_brand, p_name)
    SELECT md5(concat_ws('-', p_brand, p_name)) AS part_id, *
    FROM (SELECT * FROM seeded UNION ALL SELECT * FROM discovered))"""
PERIOD_DIM = """(
    SELECT DISTINCT md5(CAST(year(o_orderdate) AS VARCHAR)) AS period_id,
           CAST(year(o_orderdate) AS INTEGER) AS ship_year
    FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999)"""
FACT_LINES = f"""(
    SELECT md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS line_id,
           s.supplier_id, d.part_id, y.period_id, l_quantity, l_extendedprice
    FROM {LATEST_LINES} l
    JOIN part p ON p.p_partkey = l.l_partkey
    JOIN {SUPPLIER_DIM} s ON s.s_suppkey = l.l_suppkey
    JOIN {PART_DIM} d ON d.p_brand = p.p_brand AND d.p_name = p.p_name
    JOIN {PERIOD_DIM} y ON y.ship_year = year(l.l_shipdate))"""

ORACLES["dim_supplier_key"] = f"SELECT * FROM {SUPPLIER_DIM}"

ORACLES["dim_part_extended"] = f"SELECT *, is_in_catalog AS mandatory_flag FROM {PART_DIM}"

ORACLES["part_conflicts"] = """
SELECT p_brand, p_name, count(DISTINCT p_type) AS variants FROM part
GROUP BY p_brand, p_name HAVING count(DISTINCT p_type) > 1"""

ORACLES["fact_lineitem_star"] = f"""
SELECT line_id, supplier_id, part_id, period_id, l_quantity, l_extendedprice,
       true AS not_reviewed
FROM {FACT_LINES}"""

ORACLES["mart_lineitem"] = f"""
SELECT f.line_id, s.s_name AS supplier_name, d.p_brand, d.p_name, d.p_type, d.is_in_catalog,
       y.ship_year, f.l_quantity, f.l_extendedprice
FROM {FACT_LINES} f
JOIN {SUPPLIER_DIM} s USING (supplier_id)
JOIN {PART_DIM} d USING (part_id)
JOIN {PERIOD_DIM} y USING (period_id)"""

ORACLES["mart_lineitem_by_type"] = f"""
SELECT d.p_type, d.is_in_catalog, y.ship_year, count(*) AS lines,
       CAST(sum(CAST(f.l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity
FROM {FACT_LINES} f JOIN {PART_DIM} d USING (part_id) JOIN {PERIOD_DIM} y USING (period_id)
GROUP BY ALL"""

# ---- registry joins and work lists ----

ORACLES["anti_unlabelled_docs"] = """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

ORACLES["semi_labelled_docs"] = """
SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"""

ORACLES["landed_suppliers"] = """
SELECT CAST(s_suppkey AS VARCHAR) || '-1998' AS file_key, s_suppkey, s_name,
       'orders/' || CAST(max(l_orderkey) AS VARCHAR) AS path
FROM supplier JOIN lineitem ON l_suppkey = s_suppkey
WHERE year(l_shipdate) = 1998 GROUP BY s_suppkey, s_name"""

ORACLES["attempt_matrix"] = f"""
WITH days AS (SELECT unnest({list(MONTH)}) AS day),
counted AS (
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n,
           max(CASE WHEN value > 250 THEN 'value too high' END) AS error
    FROM events GROUP BY 1, 2)
SELECT u.user_id, d.day,
       CASE WHEN error IS NULL THEN coalesce(n, 0) ELSE 0 END AS result_count,
       CASE WHEN error IS NULL THEN 'ok' ELSE 'ERR' END AS status, error
FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN days d
LEFT JOIN counted c ON c.user_id = u.user_id AND c.day = d.day"""

ORACLES["failure_gate"] = """
SELECT count(*) AS attempts, count(*) FILTER (event_type = 'error') AS failed,
       count(*) FILTER (event_type = 'error') > count(*) // 2 AS gate_broken
FROM events"""

# ---- quality ----

ORACLES["fk_violations"] = f"""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE {URGENT})"""

LABELLED = "(SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"
_COUNTED = {
    ("lineitem", "not_null(l_orderkey)"): "lineitem WHERE l_orderkey IS NULL",
    ("lineitem", "accepted_values(l_returnflag)"): "lineitem WHERE l_returnflag NOT IN ('A', 'N')",
    ("lineitem", "unique(l_orderkey, l_linenumber)"): (
        "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"
    ),
    ("lineitem", "unique(l_orderkey)"): (
        "(SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)"
    ),
    ("events", "accepted_values(event_type)"): (
        "events WHERE event_type NOT IN ('click', 'view', 'signup')"
    ),
    ("labelled", "not_null(quality)"): f"{LABELLED} WHERE quality IS NULL",
    ("labelled", "accepted_values(quality)"): f"{LABELLED} WHERE quality NOT IN (1)",
    ("labelled", "accepted_values(lang)"): f"{LABELLED} WHERE lang NOT IN ('fr', 'en')",
    ("labelled", "unique(doc_id)"): (
        f"(SELECT 1 FROM {LABELLED} GROUP BY doc_id HAVING count(*) > 1)"
    ),
    ("labelled", "clean"): f"{LABELLED} WHERE NOT (quality = 1 OR toxic = 0)",
}
ORACLES["not_null_unique_accepted"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{check}' AS check_name, count(*) AS failures, "
    f"count(*) = 0 AS passed FROM {failing}"
    for (name, check), failing in _COUNTED.items()
)

ORACLES["duplicate_line_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLES["unit_interval_violations"] = """
SELECT event_id, value / 100 AS score FROM events WHERE value / 100 < 0 OR value / 100 > 1"""

# every form in which a value may stand, next to the text in which that form is looked for
ORACLES["value_in_source"] = """
WITH forms AS (
    SELECT event_id, props, CAST(value AS DECIMAL(28,6)) AS number, NULL AS word, [
        {'form': printf('%.0f', trunc(value + 0.5)), 'place': translate(props, ', ', '')},
        {'form': printf('%.6f', value), 'place': props}] AS accepted
    FROM events WHERE event_type <> 'view'
    UNION ALL
    SELECT event_id, props, NULL, upper(props[3]),
        [{'form': lower(props[3]), 'place': lower(props)}] FROM events WHERE event_type = 'view')
SELECT event_id, CAST(number AS DOUBLE) AS number, word, props FROM forms
WHERE len(list_filter(accepted, lambda a: contains(a.place, a.form))) = 0"""

ORACLES["snippet_value"] = """
SELECT event_id, CASE WHEN event_type = 'view' THEN contains(lower(props), 'k')
    ELSE contains(snippet, replace(printf('%.0f', value / 8), '.', ''))
      OR contains(snippet, replace(printf('%.1f', value / 8), '.', ''))
      OR contains(snippet, replace(printf('%.2f', value / 8), '.', '')) END AS found
FROM (SELECT *, replace(replace(lower('Total, ' || props), ',', ''), ' ', '') AS snippet FROM events)"""

# ---- text ----

ORACLES["passage_in_document"] = """
SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))"""


def excerpts(pages: str, topics: Mapping[str, Sequence[str]], budget: int) -> str:
    hits = " UNION ALL ".join(
        f"SELECT '{topic}' AS topic, * FROM chunks WHERE "
        + " OR ".join(f"contains(lower(chunk), '{word}')" for word in words)
        for topic, words in topics.items()
    )
    names = ", ".join(f"('{topic}')" for topic in topics)
    return f"""(
    WITH pages_in AS (SELECT * FROM {pages}),
    chunks AS (
        SELECT report_id, page, '[page ' || page || ']' || chr(10) || coalesce(text, '')
               || CASE WHEN page = max(page) OVER (PARTITION BY report_id) THEN ''
                       ELSE chr(10) || chr(10) END AS chunk
        FROM pages_in),
    hits AS ({hits}),
    totals AS (
        SELECT *, sum(length(chunk)) OVER (PARTITION BY report_id, topic ORDER BY page) AS total
        FROM hits),
    selected AS (
        SELECT report_id, topic, count(*) AS page_count,
               string_agg(chunk, chr(10) || chr(10) ORDER BY page) AS selection
        FROM totals WHERE total <= {budget} GROUP BY report_id, topic),
    heads AS (
        SELECT report_id, left(string_agg(chunk, '' ORDER BY page), {budget}) AS head
        FROM chunks GROUP BY report_id)
    SELECT h.report_id, t.topic, coalesce(page_count, 0) AS page_count,
           selection IS NULL AS from_head, coalesce(selection, head) AS excerpt
    FROM heads h CROSS JOIN (VALUES {names}) t(topic)
    LEFT JOIN selected s ON s.report_id = h.report_id AND s.topic = t.topic)"""


ORACLES["page_keyword_filter"] = f"""
SELECT report_id, topic, page_count, from_head, length(excerpt) AS n_chars, md5(excerpt) AS digest
FROM {excerpts(LINES, LINE_TOPICS, BUDGET)}"""

ORACLES["page_budget_prefix"] = f"""
SELECT report_id, page, n_chars FROM (
    SELECT report_id, page, length(text) AS n_chars,
           sum(length(text)) OVER (PARTITION BY report_id ORDER BY page) AS total FROM {CHAT})
WHERE total <= {BUDGET}"""

ORACLES["assembled_text"] = f"""
SELECT report_id, count(*) AS page_count,
       string_agg('[page ' || page || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY page) AS text
FROM {CHAT} WHERE page <= 200 GROUP BY report_id"""

ORACLES["split_pages"] = f"""
SELECT report_id, page, length('[page ' || page || ']') + 1 + length(text)
    + CASE WHEN page = max(page) OVER (PARTITION BY report_id) THEN 0 ELSE 2 END AS chunk_chars
FROM {CHAT}"""


# the prompt as it must read
PROMPT = """Read the report excerpt and list the figures it discloses.

Company: <company>
Fiscal year: 2024
Topic: <topic>
Language: en

Figures wanted:
<catalogue>

Answer with a JSON object holding a list named metrics. Give only values written in the
excerpt, each with its page (source_page), a quote of at least 20 characters
(source_snippet), the parent code (esrs_disclosure), the name as listed (metric_name),
either value_numeric or value_text, the unit, and your certainty between 0 and 1
(model_confidence). Leave out what is not disclosed; answer yes-no figures as text.

Excerpt:
---
<excerpt>
---
"""


def prompt() -> str:
    rows = ", ".join(
        f"({at}, {text(topic)}, {text(code)}, {text(name)}, {text(unit or '')})"
        for at, (topic, code, name, unit) in enumerate(METRIC_CATALOGUE)
    )
    entry = "'  - ' || string_split(code, '.')[1] || ': ' || name || ' (unit: ' || unit || ')'"
    listed = f"""(SELECT coalesce(string_agg({entry}, chr(10) ORDER BY place), '')
        FROM (VALUES {rows}) c(place, about, code, name, unit) WHERE about = topic)"""
    filled = f"replace({text(PROMPT)}, '<company>', 'Company ' || report_id)"
    for mark, value in (("<topic>", "topic"), ("<catalogue>", listed), ("<excerpt>", "excerpt")):
        filled = f"replace({filled}, '{mark}', {value})"
    return filled


ORACLES["prompt_rows"] = f"""
SELECT report_id, topic, length(prompt) AS n_chars, md5(prompt) AS digest
FROM (SELECT report_id, topic, {prompt()} AS prompt
      FROM {excerpts(CHAT, CHAT_TOPICS, BUDGET)})"""

# ---- payloads ----

ORACLES["payload_parse"] = """
SELECT event_id, event_type <> 'click' AS is_list,
       CASE WHEN event_type <> 'click' THEN 'E1-6' END AS code,
       CASE WHEN event_type <> 'click' THEN 12 END AS page,
       CASE WHEN event_type <> 'click' THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS number,
       event_type NOT IN ('click', 'error') AS sound
FROM events"""

ORACLES["payload_accept"] = """
WITH typed AS (
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type,
           CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
judged AS (
    SELECT user_id, day, event_type, bool_and(k < 80) AS accepted, count(*) AS item_count
    FROM typed WHERE event_type IN ('click', 'view') GROUP BY ALL)
SELECT w.user_id, w.day, coalesce(c.event_type, v.event_type, 'failed') AS outcome,
       coalesce(c.item_count, v.item_count, 0) AS item_count
FROM (SELECT DISTINCT user_id, day FROM typed) w
LEFT JOIN judged c ON c.user_id = w.user_id AND c.day = w.day AND c.event_type = 'click' AND c.accepted
LEFT JOIN judged v ON v.user_id = w.user_id AND v.day = w.day AND v.event_type = 'view' AND v.accepted"""

ORACLES["record_rules"] = """
SELECT doc_id, len(broken) AS broken, array_to_string(broken, ',') AS violations FROM (
    SELECT doc_id, list_filter([
        CASE WHEN (quality IS NULL) = NOT (quality IS NULL AND lang = 'fr') THEN 'exactly_one' END,
        CASE WHEN lang NOT IN ('fr', 'en') THEN 'lang_value' END,
        CASE WHEN length(source) NOT BETWEEN 5 AND 10 THEN 'source_length' END,
        CASE WHEN NOT regexp_matches(text, '\\S') THEN 'text_blank' END,
        CASE WHEN length(text) NOT BETWEEN 20 AND 2000 THEN 'text_length' END],
        lambda x: x IS NOT NULL) AS broken
    FROM documents LEFT JOIN labels USING (doc_id))"""

ORACLES["registry_rules"] = """
SELECT page_id, array_to_string(list_filter([
    CASE WHEN NOT regexp_matches(url, '^https?://[^\\s/?#]+') THEN 'url_http' END,
    CASE WHEN NOT starts_with(url, 'https://') THEN 'url_https' END,
    CASE WHEN regexp_extract(url, '^[^/]*//[^/]*/([a-z]+)/', 1) NOT IN ('fr', 'en')
         THEN 'language_code' END,
    CASE WHEN length(url) NOT BETWEEN 2 AND 40 THEN 'url_length' END],
    lambda x: x IS NOT NULL), ',') AS violations
FROM pages"""

ORACLES["magic_admission"] = """
SELECT page_id, length(html) AS n_chars FROM pages
WHERE starts_with(html, '<!DOCTYPE html>')
  AND page_id NOT IN (SELECT doc_id FROM labels WHERE quality > 0)"""

# ---- scoring and codes ----

ORACLES["confidence_score"] = f"""
WITH base AS (
    SELECT doc_id, coalesce(toxic, 0) = 0 AS structural, coalesce(quality, 1) = 1 AS snippet,
           lang IN ('fr', 'en') AS spoken,
           -5.0::DOUBLE * (1.0::DOUBLE - least(1.0::DOUBLE, greatest(0.0::DOUBLE,
               CASE WHEN source <> 'src3' THEN n_chars / 3000.0::DOUBLE ELSE 0.5::DOUBLE END))) AS logprob
    FROM documents LEFT JOIN labels USING (doc_id)),
penalised AS (
    SELECT doc_id, structural,
           least(1.0::DOUBLE, greatest(0.0::DOUBLE, (logprob + 5.0::DOUBLE) / 5.0::DOUBLE))
           * CASE WHEN snippet THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END
           * CASE WHEN spoken THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS x
    FROM base)
SELECT doc_id, CASE WHEN structural THEN {three_decimals("x")}
                    ELSE 0.0::DOUBLE END AS score
FROM penalised"""

ORACLES["parent_codes"] = """
SELECT page_id, split_part(regexp_extract(url, '^[a-z]+://([^/]+)', 1), '.', 1) AS code FROM pages"""

ORACLES["display_value"] = f"""
WITH named AS (
    SELECT *, CASE event_type WHEN 'click' THEN CAST(value AS DECIMAL(12,2)) * 37
                              WHEN 'purchase' THEN CAST(value AS DECIMAL(12,2)) END AS number,
           props || event_type || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS long_text
    FROM events),
written AS (
    SELECT *, regexp_replace(CAST(CAST(number AS DECIMAL(18,2)) AS VARCHAR), '\\.?0+$', '') AS plain,
           replace(format('{{:,}}', CAST(floor(number) AS BIGINT)), ',', chr(8239)) AS grouped
    FROM named)
SELECT event_id,
       CASE WHEN number >= 1000 THEN grouped
                || CASE WHEN contains(plain, '.') THEN ',' || split_part(plain, '.', 2) ELSE '' END
            WHEN number IS NOT NULL THEN plain
            WHEN event_type = 'view' THEN props ELSE '—' END
       || CASE WHEN event_type = 'click' THEN ' EUR' ELSE '' END AS shown,
       printf('%.1f%%', CAST({EVENT_SCORE} * 100 AS DOUBLE)) AS score,
       CASE event_type WHEN 'click' THEN 'C — Click' WHEN 'view' THEN 'V — View'
                       WHEN 'error' THEN 'E — Error' END AS label,
       upper(event_type) AS code, strftime(ts, '%Y-%m-%d') AS day,
       CASE WHEN length(long_text) > 40 THEN left(long_text, 40) || '…' ELSE long_text END AS preview
FROM written"""

# ---- reports ----

ORACLES["count_by_model"] = """
SELECT event_type, count(*) AS row_count FROM events GROUP BY 1 ORDER BY 1"""

ORACLES["row_counts"] = """
SELECT coalesce(o_orderstatus, 'all') AS o_orderstatus, count(*) AS row_count
FROM orders GROUP BY ROLLUP (o_orderstatus)"""

ORACLES["mean_score"] = f"""
SELECT c_custkey, coalesce(m, 0.0::DOUBLE) AS mean_score FROM customer LEFT JOIN (
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / count(*) AS m
    FROM orders WHERE {URGENT} GROUP BY 1) ON o_custkey = c_custkey"""

ORACLES["topic_profile"] = f"""
SELECT source, lang, CAST(list_position({list(LANGUAGE_ORDER[:3])}, lang) AS BIGINT) AS topic_position,
       count(*) AS total, count(*) FILTER (score >= 0.8) AS published,
       count(*) FILTER (score < 0.8) AS review
FROM {JUDGED} WHERE lang IN ('fr', 'en', 'de') GROUP BY source, lang"""

EXPOSED = """(
    SELECT c_custkey AS ticker,
           CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(12,2)) ELSE 0 END AS exposure,
           CAST(o_totalprice AS DECIMAL(14,2)) AS amount
    FROM customer LEFT JOIN (
        SELECT o_custkey, o_totalprice FROM orders
        WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) < 1999
        QUALIFY row_number() OVER (
            PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_orderkey) = 1
    ) ON o_custkey = c_custkey)"""

ORACLES["portfolio_exposure"] = f"""
SELECT ticker, CAST(exposure AS DOUBLE) AS exposure, CAST(coalesce(amount, -1) AS DOUBLE) AS amount,
       coalesce(CASE WHEN exposure > 0 THEN CAST(floor(
           CAST(amount AS DOUBLE) / CAST(exposure AS DOUBLE) + 0.5::DOUBLE) AS BIGINT) END, -1) AS intensity
FROM {EXPOSED}"""

ORACLES["portfolio_totals"] = f"""
SELECT CAST(sum(exposure) AS DOUBLE) AS total_exposure, CAST(sum(amount) AS DOUBLE) AS total_amount,
       count(amount) AS covered,
       CAST(floor(CAST(sum(amount) AS DOUBLE) / CAST(sum(exposure) AS DOUBLE) + 0.5::DOUBLE) AS BIGINT)
           AS intensity
FROM {EXPOSED}"""

ORACLES["coverage"] = f"""
SELECT count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders WHERE {URGENT})) AS covered,
       count(*) AS entities FROM customer"""

ORACLES["sequence_in_group"] = """
SELECT o_orderkey, concat_ws('-', CAST(o_custkey AS VARCHAR), CAST(row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS VARCHAR)) AS id
FROM orders"""

URGENT_TOTALS = f"""(
    SELECT c_nationkey, c_name, largest FROM customer LEFT JOIN (
        SELECT o_custkey, max(o_totalprice) AS largest FROM orders WHERE {URGENT} GROUP BY 1
    ) ON o_custkey = c_custkey)"""

ORACLES["top1_nulls_last"] = f"""
SELECT * FROM {URGENT_TOTALS} ORDER BY largest DESC NULLS LAST, c_name LIMIT 1"""

ORACLES["top_customer_per_nation"] = f"""
SELECT * FROM {URGENT_TOTALS} QUALIFY row_number() OVER (
    PARTITION BY c_nationkey ORDER BY largest DESC NULLS LAST, c_name) = 1"""

ORACLES["nested_snapshot"] = """
WITH numbered AS (
    SELECT n_name, s_suppkey, s_name, s_acctbal,
           row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey) - 1 AS number
    FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT n_name, number // 10000 AS part, count(*) AS item_count,
       CAST(to_json(list({'id': n_name || '-' || number, 'supplierKey': s_suppkey, 'name': s_name,
            'rating': CASE WHEN s_acctbal > 0 THEN 'ok' END} ORDER BY number)) AS VARCHAR) AS items
FROM numbered GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
