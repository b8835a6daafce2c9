"""DuckDB twins of the queries that SQL can express, written on their own."""

from __future__ import annotations

from goldleaf.llm.license_scan import TEMPLATES, THRESHOLD

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_AZ}), {_WORD})"


LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_AZ}) AS k FROM lines),
shared AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT l.doc_id, l.pos, l.line, coalesce(s.owner <> l.doc_id, false) AS gone FROM keyed l LEFT JOIN shared s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LICENSE_SCAN = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_words('text')} AS w FROM documents),
placed AS (
  SELECT doc_id, text, w,
    list_filter(range(1, len(w)), lambda i: w[i] = 'mit' AND w[i + 1] = 'license') AS mit,
    list_filter(range(1, len(w)), lambda i: w[i] = 'apache' AND w[i + 1] = 'license') AS apache,
    list_filter(range(1, len(w) - 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS gpl
  FROM d),
base AS (
  SELECT doc_id, len(w) AS n_words, list_concat(list_concat(mit, apache), gpl) AS spots,
    list_concat(list_concat(CASE WHEN len(apache) > 0 THEN ['apache'] ELSE [] END, CASE WHEN len(gpl) > 0 THEN ['gpl'] ELSE [] END),
      CASE WHEN len(mit) > 0 THEN ['mit'] ELSE [] END) AS base FROM placed),
tpl AS (
  SELECT label, list_distinct({_words('t')}) AS t
  FROM (VALUES {', '.join(f'({_quoted(a)}, {_quoted(b)})' for a, b in TEMPLATES)}) v(label, t)),
blocks AS (
  SELECT doc_id, list_distinct({_words('line')}) AS b
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
found AS (
  SELECT doc_id, label, len(list_intersect(t, b)) / len(t) AS c FROM blocks, tpl
  WHERE len(list_intersect(t, b)) >= ceil(round({THRESHOLD} * len(t), 9))),
per_doc AS (SELECT doc_id, list(DISTINCT label) AS own, max(c) AS best FROM found GROUP BY doc_id)
SELECT doc_id, n_words, len(spots) AS n_base, list_min(spots) - 1 AS first_word, list_max(spots) - 1 AS last_word,
  array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(own, [])))), ',') AS labels,
  CASE WHEN len(spots) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM base LEFT JOIN per_doc USING (doc_id)
"""

# Escapes add one character for each control string.
_CONTROL = r"'<\\*(\|\w*\|>|/?s>)|\[\\*/?INST\]'"
CHAT_FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER w AS head, row_number() OVER w AS k,
    length(text) + len(regexp_extract_all(text, {_CONTROL})) AS text_chars,
    length(role) + len(regexp_extract_all(role, {_CONTROL})) AS role_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(text_chars + CASE WHEN head THEN 12 + role_chars + 10 + 11 ELSE 10 END)::BIGINT AS formatted_chars,
  count(*) FILTER (head) AS n_messages
FROM marked GROUP BY conv_id
"""

DECONTAMINATION = f"""
WITH dw AS (SELECT doc_id, {_words('text')} AS w FROM documents),
iw AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM spans),
own AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens)),
hits AS (SELECT doc_id, n, i, item_id FROM own JOIN spans USING (n, t)),
cover AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

FILTER_AUDIT = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
f AS (
  SELECT doc_id, part,
    (CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM w),
says AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS bad
  FROM f LEFT JOIN says USING (doc_id) GROUP BY part, fails),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, k, substr(o, k, 1) AS letter, substr(o, 1, k - 1) AS before FROM orders, range(1, 6) r(k)),
counted AS (
  SELECT part, o, k, letter,
    coalesce(sum(n) FILTER (translate(fails, before || letter, '') = fails), 0) AS kept,
    coalesce(sum(n) FILTER (contains(fails, letter) AND translate(fails, before, '') = fails), 0) AS removed,
    coalesce(sum(n) FILTER (contains(fails, letter) AND translate(fails, before, '') <> fails), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
    coalesce(sum(good) FILTER (contains(fails, letter) AND translate(fails, before, '') = fails), 0) AS good_lost,
    coalesce(sum(bad) FILTER (contains(fails, letter) AND translate(fails, before, '') = fails), 0) AS toxic_lost
  FROM steps, cells GROUP BY ALL)
SELECT part, o AS filter_order, CAST(k AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""

ORACLES = {
    "op1_line_dedup": LINE_DEDUP,
    "op4_license_scan": LICENSE_SCAN,
    "op5_chat_format": CHAT_FORMAT,
    "op8_decontamination": DECONTAMINATION,
    "op11_filter_audit": FILTER_AUDIT,
}
