"""Contamination as DuckDB SQL: every window of every text, compared as text."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "coalesce(regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

CONTAMINATION = f"""
WITH items AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM items)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, (SELECT DISTINCT n FROM items))),
hits AS (SELECT d.doc_id, d.n, d.i, t.item_id FROM doc_windows d JOIN item_windows t USING (n, win)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
lists AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(l.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(l.list, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words h USING (doc_id) LEFT JOIN lists l USING (doc_id)
"""
