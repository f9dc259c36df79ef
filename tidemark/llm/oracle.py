"""Comparison SQL of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from tidemark.llm.line_rules import BOILERPLATE, NAVIGATION

SQL: dict[str, str] = {}

SQL["op2_byte_repeats"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT r, doc_id, unnest(range(0, length(h) // 2 - 49)) AS s FROM d
), win AS (
  SELECT starts.r, starts.doc_id, s, md5_number(substr(h, 2 * s + 1, 100)) AS w
  FROM starts JOIN d USING (r)
), first AS (
  SELECT w, min(doc_id) AS least FROM win GROUP BY w
), hit AS (
  SELECT r, s, s - row_number() OVER (PARTITION BY r ORDER BY s) AS run FROM win JOIN first USING (w) WHERE least < doc_id
), runs AS (
  SELECT r, min(s) AS a, max(s) + 50 AS b FROM hit GROUP BY r, run
), placed AS (
  SELECT r, a, b, max(b) OVER (PARTITION BY r ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM runs
), numbered AS (
  SELECT *, sum(CASE WHEN before IS NULL OR a > before THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY a) AS n FROM placed
), spans AS (
  SELECT r, n, min(a) AS a, max(b) AS b FROM numbered GROUP BY r, n
), edges AS (
  SELECT r, b AS x, coalesce(lead(a) OVER (PARTITION BY r ORDER BY a), 1000000000) AS y FROM spans
  UNION ALL SELECT r, 0, min(a) FROM spans GROUP BY r
), kept AS (
  SELECT r, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k FROM edges JOIN d USING (r) GROUP BY r
), counts AS (
  SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN counts USING (r) LEFT JOIN kept USING (r)
"""

SQL["op7_warc"] = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), g AS (
  SELECT *, count(*) OVER same AS copies, max(page_id) OVER same AS top FROM p
  WINDOW same AS (PARTITION BY payload_digest, payload_bytes)
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND copies > 1 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND copies > 1 AND page_id < top THEN top END AS refers_to
FROM g
"""

SQL["op9_voronoi_knn"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.c, d.c), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v AS q JOIN v AS d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

_LINES = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), win AS (
  SELECT r, s, array_to_string(list_slice(words, s, s + 7), ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS s FROM d)
), again AS (
  SELECT r, w FROM win GROUP BY r, w HAVING count(*) > 1
), covered AS (
  SELECT r, sum(least(8, s - coalesce(last, -8))) AS n FROM (
    SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS last FROM win SEMI JOIN again USING (r, w)) GROUP BY r
), line AS (
  SELECT r, l, len(list_filter(string_split_regex(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
), judged AS (
  SELECT r, l, n,
    length(l) - length(translate(l, '.,;:!?…。、！？؟।', '')) > 0
    AND (length(l) - length(translate(l, '#*$%&|<>', ''))) * 100 <= n * 50
    AND NOT regexp_matches(lower(trim(l)), '^[^a-z]*(?:NAV)[^a-z]*$')
    AND NOT (length(l) - length(translate(l, '|»›>•·', '')) >= 3
             AND (length(l) - length(translate(l, '|»›>•·', ''))) * 100 >= n * 20)
    AND NOT regexp_matches(lower(l), 'BOILER') AS passes
  FROM line WHERE n > 0
), lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS dup, sum(CASE WHEN passes THEN n ELSE 0 END) AS kept_words FROM judged GROUP BY r
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(kept_words, 0) AS kept_words
  FROM d LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND kept_words * 100 >= n_words * 50 AS kept
FROM measured
"""
SQL["op8_quality_rules"] = _LINES.replace("NAV", "|".join(NAVIGATION)).replace("BOILER", "|".join(BOILERPLATE))

SQL["op10_repeated_passages"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), starts AS (
  SELECT r, unnest(range(1, len(words) - 33)) AS s FROM d
), win AS (
  SELECT starts.r, s, array_to_string(list_slice(words, s, s + 34), ' ') AS w FROM starts JOIN d USING (r)
), again AS (
  SELECT w FROM win GROUP BY w HAVING count(*) > 1
), gone AS (
  SELECT r, list_sort(list_distinct(flatten(list(range(s, s + 35))))) AS hit FROM win SEMI JOIN again USING (w) GROUP BY r
), kept AS (
  SELECT r, doc_id, len(words) AS n_words, len(coalesce(hit, [])) AS n_removed,
    CASE WHEN hit IS NULL THEN words ELSE list_select(words, list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(hit, i))) END AS left_words
  FROM d LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept
"""
