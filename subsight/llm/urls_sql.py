"""URL judgement as DuckDB SQL: one bounded pattern per vocabulary term."""

from subsight.llm.urls import RULES, SOFT, SOFT_DISTINCT, STRICT

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _count(terms) -> str:
    return " + ".join(f"CASE WHEN regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])', 's') THEN 1 ELSE 0 END" for t in sorted(set(terms)))


def _rules(what) -> str:
    by_length = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{what(h, p, v)}'" for h, p, v in by_length) + " END"


VERDICTS = f"""
WITH parts AS (
  SELECT page_id, {_LOWER.format("coalesce(url, '')")} AS low,
         {_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
counted AS (
  SELECT *, ({_count(STRICT)})::INT AS n_strict, ({_count(set(SOFT) - set(STRICT))})::INT AS n_soft,
         {_rules(lambda h, p, v: h + p)} AS rule, {_rules(lambda h, p, v: v)} AS ruled
  FROM parts)
SELECT page_id, host, path, rule, n_strict, n_soft,
       coalesce(ruled, CASE WHEN n_strict >= 1 OR n_soft >= {SOFT_DISTINCT} THEN 'block' ELSE 'allow' END) AS verdict
FROM counted
"""
