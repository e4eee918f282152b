"""Collocations as DuckDB SQL: every phrase of every piece as text, counted, cut and ranked."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, coalesce(regexp_extract_all(piece, '[^\x20\x09]+'), []) AS w FROM pieces),
phrases AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS k))
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r,
         ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM candidates) c
  JOIN phrases l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
covered AS (
  SELECT DISTINCT lang, phrase FROM (
    SELECT t.lang, t.a AS longer, unnest([array_to_string(t.w[1:2], ' '), array_to_string(t.w[2:3], ' ')]) AS phrase
    FROM candidates t WHERE t.k = 3) s
  JOIN candidates c USING (lang, phrase) WHERE 100 * s.longer >= 50 * c.a),
ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM weakest w LEFT JOIN covered v ON v.lang = w.lang AND v.phrase = w.phrase WHERE v.phrase IS NULL)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
