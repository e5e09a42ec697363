"""DuckDB SQL of the queries that SQL can express: by plain counting and comparing of all pairs."""

from __future__ import annotations

from tracebook.llm.licenses import PHRASES, TEMPLATES

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

LOWER_OR_NULL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOWER = f"coalesce({LOWER_OR_NULL}, '')"

LINE_FREQUENCY_RULES = rf"""
WITH base AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(source, '') AS host, coalesce(text, '') AS text, {WORDS} AS w
    FROM documents),
windows AS (
    SELECT r, i, array_to_string(w[i:i + 7], ' ') AS win
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base)),
again AS (
    SELECT r, count(DISTINCT i + k) AS n FROM (
        SELECT r, i, unnest(range(0, 8)) AS k FROM (
            SELECT *, count(*) OVER (PARTITION BY r, win) AS times FROM windows) WHERE times > 1)
    GROUP BY r),
plain AS (
    SELECT r, host, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(
        regexp_replace(lower(x), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))), lambda x: x <> '') AS every
    FROM base),
named AS (SELECT r, host, unnest(every) AS line, array_to_string(every, chr(10)) AS counted_as FROM plain),
frequent AS (
    SELECT host, line FROM named JOIN (
        SELECT host, count(DISTINCT counted_as) AS host_docs FROM named GROUP BY host) USING (host)
    GROUP BY host, line, host_docs
    HAVING count(DISTINCT counted_as) > 20 AND count(DISTINCT counted_as) > 0.02 * host_docs),
lost AS (
    SELECT r, sum(len(string_split(line, ' '))) AS n FROM named JOIN frequent USING (host, line) GROUP BY r),
counted AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
            - len(list_distinct(list_filter(string_split(text, chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(w) - coalesce(lost.n, 0) AS BIGINT) AS n_own_words
    FROM base LEFT JOIN again USING (r) LEFT JOIN lost USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * n_own_words >= 30 * n_words AS kept, n_own_words
FROM judged"""

SUBSTRING_DEDUP = rf"""
WITH base AS (SELECT doc_id, row_number() OVER () AS r, {WORDS} AS w FROM documents),
windows AS (
    SELECT r, i, array_to_string(w[i:i + 34], ' ') AS win
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM base)),
covered AS (
    SELECT DISTINCT r, i + k AS spot FROM (
        SELECT r, i, unnest(range(0, 35)) AS k FROM windows
        WHERE win IN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1))),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS spot FROM base),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY spot) AS left_text, count(*) AS n
    FROM words ANTI JOIN covered USING (r, spot) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(left_text, '')) AS kept_sha256
FROM base LEFT JOIN kept USING (r)"""


def license_scan(threshold: float = 0.8) -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrases = ", ".join(f"('{phrase}', '{label}')" for phrase, label in PHRASES.items())
    templates = ", ".join(f"({n}, '{text}', '{label}')" for n, (text, label) in enumerate(TEMPLATES))
    return rf"""
WITH base AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER}, '{word}') AS w FROM documents),
words AS (SELECT r, unnest(w) AS word, unnest(range(0, len(w))) AS spot FROM base),
phrases AS (SELECT string_split(p, ' ') AS parts, label FROM (VALUES {phrases}) t(p, label)),
places AS (
    SELECT r, label, spot FROM words JOIN phrases ON word = parts[1] JOIN base USING (r)
    WHERE w[spot + 1:spot + len(parts)] = parts),
found AS (
    SELECT r, count(*) AS n, min(spot) AS first_word, max(spot) AS last_word, list_distinct(list(label)) AS labels
    FROM places GROUP BY r),
templates AS (
    SELECT n AS t, label, string_split(t, ' ') AS parts, list_distinct(string_split(t, ' ')) AS want
    FROM (VALUES {templates}) t(n, t, label)),
wanted AS (SELECT t, unnest(want) AS word FROM templates),
hits AS (SELECT r, t, word, spot FROM words JOIN wanted USING (word)),
blocks AS (
    SELECT s.r, s.t, s.spot, count(DISTINCT h.word) AS n
    FROM hits s JOIN templates USING (t) JOIN hits h
        ON h.r = s.r AND h.t = s.t AND h.spot >= s.spot AND h.spot < s.spot + floor(len(parts) / {threshold} + 1e-9)
    GROUP BY ALL),
held AS (
    SELECT r, list_distinct(list(label)) AS labels, max(n / len(want)) AS score
    FROM blocks JOIN templates USING (t) WHERE n >= {threshold} * len(want) - 1e-9 GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(found.n, 0) AS BIGINT) AS n_base,
    CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
    array_to_string(list_sort(coalesce(found.labels, [])), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(found.labels, []), coalesce(held.labels, [])))), ',')
        AS labels,
    CASE WHEN found.n > 0 THEN 1.0::DOUBLE ELSE coalesce(held.score, 0)::DOUBLE END AS score
FROM base LEFT JOIN found USING (r) LEFT JOIN held USING (r)"""


COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
f AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS n
    FROM starts, (VALUES (1), (2), (3)) sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang),
found AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
cut AS (
    SELECT *, array_to_string(w[:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS j FROM found)),
scored AS (
    SELECT c.lang, c.phrase, c.k, c.a, j, h.n AS l, t.n AS r, (1000000 * a * a) // (h.n * t.n) AS score
    FROM cut c JOIN f h ON h.lang = c.lang AND h.phrase = head JOIN f t ON t.lang = c.lang AND t.phrase = rest),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM scored),
inner_parts AS (
    SELECT lang, a, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS phrase
    FROM found WHERE k = 3),
kept AS (
    SELECT * FROM lowest s WHERE nth = 1 AND NOT EXISTS (
        SELECT 1 FROM inner_parts i WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100 * i.a >= 50 * s.a)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

# the polynomial of the usual crc32, bit by bit
CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
        lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    parts = [f"coalesce(octet_length(encode({f}::VARCHAR))::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


MERKLE = rf"""
WITH RECURSIVE base AS (
    SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf,
        CASE WHEN text IS NOT NULL AND {CRC32} % 5 = 0 THEN {_leaf(LOWER_OR_NULL)} END AS changed FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY source) AS n FROM base),
own AS (
    SELECT source, 0 AS level, place, n, leaf AS digest FROM placed
    UNION ALL
    SELECT source, level + 1, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
    FROM own WHERE n > 1 GROUP BY source, level, place // 16, n),
subroots AS (
    SELECT source, level AS top, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
        count(*) OVER () AS n FROM own WHERE n = 1),
upper AS (
    SELECT 0 AS level, place, n, digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
    FROM upper WHERE n > 1 GROUP BY level, place // 16, n),
runs AS (
    SELECT false AS high, source, level, place // 16 AS run, list(digest ORDER BY place) AS digests
    FROM own WHERE n > 1 GROUP BY source, level, place // 16
    UNION ALL
    SELECT true, NULL, level, place // 16, list(digest ORDER BY place) FROM upper WHERE n > 1 GROUP BY level, place // 16),
steps AS (
    SELECT r, p.source, false AS high, 0 AS level, place, coalesce(changed, leaf) AS folded, '' AS proof FROM placed p
    UNION ALL
    SELECT s.r, s.source, s.high OR t.digests IS NULL,
        CASE WHEN t.digests IS NULL THEN 0 ELSE s.level + 1 END,
        CASE WHEN t.digests IS NULL THEN b.place ELSE s.place // 16 END,
        CASE WHEN t.digests IS NULL THEN s.folded ELSE sha256(
            array_to_string(t.digests[:s.place % 16], '') || s.folded
            || array_to_string(t.digests[s.place % 16 + 2:], '')) END,
        CASE WHEN t.digests IS NULL THEN s.proof ELSE s.proof
            || array_to_string(t.digests[:s.place % 16], '') || array_to_string(t.digests[s.place % 16 + 2:], '') END
    FROM steps s JOIN subroots b ON b.source IS NOT DISTINCT FROM s.source
    LEFT JOIN runs t ON t.high = s.high AND t.level = s.level AND t.run = s.place // 16
        AND (s.high OR t.source IS NOT DISTINCT FROM s.source)
    WHERE t.digests IS NOT NULL OR NOT s.high),
ends AS (SELECT r, folded, proof FROM steps QUALIFY row_number() OVER (PARTITION BY r ORDER BY high DESC, level DESC) = 1)
SELECT doc_id, p.source, leaf, b.digest AS subroot, u.digest AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = u.digest AS verified
FROM placed p JOIN ends USING (r) JOIN subroots b ON b.source IS NOT DISTINCT FROM p.source
JOIN (SELECT digest FROM upper WHERE n = 1) u ON true"""


SQL = {
    "op3_line_frequency_rules": LINE_FREQUENCY_RULES,
    "op8_license_scan": license_scan(),
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op11_phrase_collocations": COLLOCATIONS,
    "op13_merkle_manifest": MERKLE,
}
