"""DuckDB SQL with the same rows as the queries that SQL can express."""

from __future__ import annotations

from sievemart.llm import decontaminate, quality, url_rules, warc_fixity

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def _quality() -> str:
    stops = sorted(
        {w + e for t in quality.STOP_WORDS.values() for w in t.split() for e in ("", ",", ".")}
    )
    tests = []
    for rule in quality.THRESHOLDS:
        sign = "<=" if rule.sense == "at_most" else ">="
        tests.append(f"100 * {rule.measure} {sign} {rule.percent} * {rule.base}")
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
lined AS (
    SELECT *, list_filter(string_split(text, chr(10)),
        lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM texts),
counted AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words,
        length(array_to_string(ws, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(list_filter(ws, lambda w: lower(w) IN ({_quoted(stops)}))) AS n_stop_words,
        len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        len(list_filter(ls, lambda x: regexp_matches(rtrim(x, ' '), '(\.\.\.|…)$'))) AS n_cut_lines,
        len(list_filter(ls, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•]'))) AS n_bullet_lines
    FROM lined),
windows AS (
    SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS win
    FROM texts, unnest(range(1, greatest(len(ws) - 6, 1))) AS r(i)),
again AS (
    SELECT doc_id, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
repeats AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM again, unnest(range(0, 8)) AS r(k) GROUP BY doc_id),
joined AS (
    SELECT counted.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM counted LEFT JOIN repeats USING (doc_id)),
judged AS (
    SELECT *, n_words < {quality.MIN_WORDS}
        OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM joined)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {" AND ".join(tests)} AS kept
FROM judged"""


def _leaks() -> str:
    """Items of five words or more, as all in the test tables are."""

    def shingles(name: str, key: str) -> str:
        split = r"regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+')"
        return f"""
    SELECT {key}, i - 1 AS place, array_to_string(ws[i:i+4], ' ') AS shingle, len(ws) - 4 AS n
    FROM (SELECT {key}, list_filter({split}, lambda w: w <> '') AS ws FROM {name}),
        unnest(range(1, greatest(len(ws) - 3, 1))) AS r(i)"""

    return f"""
WITH held AS ({shingles("documents", "doc_id")}),
asked AS ({shingles("benchmark", "item_id")}),
windows AS (
    SELECT DISTINCT doc_id, item_id, asked.n, held.place - asked.place AS start
    FROM held JOIN asked USING (shingle)),
counted AS (
    SELECT doc_id, item_id, start, w.n, shingle, count(*) AS times
    FROM windows AS w JOIN held USING (doc_id)
    WHERE held.place BETWEEN start AND start + w.n - 1 GROUP BY ALL),
in_item AS (SELECT item_id, shingle, count(*) AS wanted FROM asked GROUP BY ALL),
scored AS (
    SELECT doc_id, item_id, start, coalesce(sum(least(times, wanted)), 0) AS common,
        sum(times) + any_value(n) AS joint
    FROM counted LEFT JOIN in_item USING (item_id, shingle) GROUP BY ALL),
ranked AS (
    SELECT *, (common * 1000000 // (joint - common))::BIGINT AS similarity_ppm FROM scored)
SELECT doc_id, item_id, start::INT AS first_word, similarity_ppm FROM ranked
WHERE similarity_ppm >= {decontaminate.SIMILARITY_PERCENT * 10_000}
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity_ppm DESC, start) = 1"""


def _substrings() -> str:
    return f"""
WITH texts AS (SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(ws[i:i+34], ' ') AS win
    FROM texts, unnest(range(1, greatest(len(ws) - 33, 1))) AS r(i)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY win) > 1),
covered AS (SELECT DISTINCT doc_id, i + k AS i FROM again, unnest(range(0, 35)) AS r(k)),
gone AS (SELECT doc_id, list(i) AS places FROM covered GROUP BY doc_id),
left_over AS (
    SELECT doc_id, len(ws) AS n_words, coalesce(len(places), 0) AS n_removed,
        CASE WHEN places IS NULL THEN ws
            ELSE list_filter(ws, lambda w, i: NOT list_contains(places, i)) END AS kept
    FROM texts LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
    sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM left_over"""


def _urls() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_rules.RULES)
    return rf"""
WITH rules(won, rule_host, rule_path) AS (VALUES {rules}),
parts AS (
    SELECT page_id, url,
        translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
best AS (
    SELECT host, path,
        arg_max(struct_pack(rule := rule_host || rule_path, won := won),
            length(rule_host || rule_path)) AS best
    FROM (SELECT DISTINCT host, path FROM parts), rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.won, 'allow') AS verdict
FROM parts LEFT JOIN best USING (host, path)"""


def _fixity() -> str:
    head = (
        "'WARC/1.0' || nl || 'WARC-Type: resource' || nl || 'WARC-Record-ID: <urn:page:'"
        " || coalesce(page_id::VARCHAR, 'None') || '>' || nl"
        f" || 'WARC-Date: {warc_fixity.WARC_DATE}' || nl || 'WARC-Target-URI: ' || coalesce(url, '')"
        " || nl || 'Content-Type: text/html' || nl || 'Content-Length: ' || strlen(body)"
        " || nl || nl || body || nl || nl"
    )
    return f"""
WITH given AS (
    SELECT page_id, url, coalesce(html, '') AS body, chr(13) || chr(10) AS nl,
        ('0x' || left(md5(coalesce(html, '')), 2))::INT AS fault
    FROM pages),
records AS (SELECT page_id, fault, {head} AS record FROM given),
found AS (
    SELECT *, CASE WHEN fault < 4 THEN 'X' || substring(record, 2)
        WHEN fault BETWEEN 8 AND 11 THEN left(record, length(record) - 1) END AS other
    FROM records WHERE fault < 12)
SELECT page_id, CASE WHEN other IS NULL THEN 'missing' ELSE 'changed' END AS kind,
    strlen(record)::BIGINT AS length, strlen(other)::BIGINT AS found_length,
    sha256(record) AS digest, sha256(other) AS found_digest
FROM found"""


def _similar_sets() -> str:
    return """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    ELSE list_distinct(list_transform(range(1, greatest(len(words) - 1, 2)),
      lambda i: array_to_string(words[i:i+2], ' '))) END AS shingles
  FROM split),
listed AS (SELECT doc_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM listed a JOIN listed b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 10 * a.size >= 9 * b.size AND 10 * b.size >= 9 * a.size
  GROUP BY a.doc_id, b.doc_id, a.size, b.size
  HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, m.b FROM reached r JOIN met m ON r.other = m.a)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)"""


def _negatives() -> str:
    return """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same,
    CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3"""


ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": _leaks(),
    "op4_merkle_fixity": _fixity(),
    "op8_quality_rules": _quality(),
    "op9_fm_substrings": _substrings(),
    "op10_url_rules": _urls(),
    "op11_ngram_join": _similar_sets(),
    "op12_angular_negatives": _negatives(),
}
