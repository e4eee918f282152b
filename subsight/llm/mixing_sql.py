"""The mix as DuckDB SQL: one pass of window sums per source instead of buckets."""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS okey
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rn
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (rn - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CASE (rn - 1) % 3 WHEN 0 THEN (-2.0::DOUBLE) / 10 WHEN 1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / 2 END AS slope,
         3 * source_size AS cap
  FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap / weight, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, slope, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.slope,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.okey, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS passes
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, passes + CASE WHEN before * 2 + size < (target - passes * source_size) * 2 THEN 1 ELSE 0 END AS copies,
         CASE WHEN target > 0 THEN least(1.0::DOUBLE, (before + size / 2) / target) ELSE 0.0 END AS u
  FROM placed)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies::BIGINT AS copies,
       CASE WHEN copies > 0 THEN u * 2 / ((1.0 - slope) + sqrt((1.0 - slope) * (1.0 - slope) + slope * 4 * u)) END AS first_position
FROM counted
"""
