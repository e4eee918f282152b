"""Conversation repair as DuckDB SQL: the cheapest edits row by row, each state with its cost, audit and text so far."""

# CRC-32 of the sixteen half bytes, polynomial 0xEDB88320.
_HALF_BYTES = [0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
               0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C]


def _half(c: str) -> str:
    return f"xor(({_HALF_BYTES}::BIGINT[])[({c} & 15) + 1], {c} >> 4)"


def _crc32(ascii_text: str) -> str:
    """CRC-32 of ASCII text."""
    codes = f"list_transform(string_split({ascii_text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {_half('(' + _half('xor(c, b)') + ')')}), 4294967295)"


def _then(state: str, cost: str, letter: str, out: str, when: str = "true") -> str:
    """``state`` after an edit, or NULL."""
    return (f"CASE WHEN {state} IS NOT NULL AND ({when}) THEN {{'c': {state}.c + ({cost}), 'a': {state}.a || '{letter}', "
            f"'o': {state}.o || {out}}} END")


def _best(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


_NONE = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR))"
_BARE = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"
_OUT = "chr(10) || role || ':' || text"


def _delete(q: str) -> str:
    return _then(q, "3", "D", "''")


def _keep(q: str, initial: str) -> str:
    return _then(q, "cut", "K", _OUT, f"stays AND initial = '{initial}'")


def _rerole(q: str, role: str) -> str:
    return _then(q, "2 + cut", "R", f"chr(10) || '{role}:' || text", "stays")


def _insert(q: str, role: str) -> str:
    return _then(q, "2", "I", f"chr(10) || '{role}:'")


_TO_USER = ("b", "s", "a")

REPAIR = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(generate_series(1, CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM given WHERE fault <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, {_BARE} = '' AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         right({_BARE}, 1) NOT IN ('.', '!', '?') AS open FROM placed),
steps AS (
  SELECT *, NOT blank AND NOT again AS stays, (NOT blank AND NOT again AND open)::BIGINT AS cut,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM judged),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::BIGINT) AS blank,
         sum((again AND NOT blank)::BIGINT) AS duplicate, sum(cut) AS truncated,
         sum((i > 1 AND prior || initial NOT IN ('su', 'ua', 'au'))::BIGINT) AS illegal, max(i) AS last
  FROM steps GROUP BY conv_id),
walk(conv_id, i, b, s, u, a) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': '', 'o': ''}}, {_NONE}, {{'c': 2::BIGINT, 'a': 'I', 'o': chr(10) || 'user:'}},
         {{'c': 4::BIGINT, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} FROM counts
  UNION ALL
  SELECT conv_id, i, b, s, u, {_best("a", _insert("u", "assistant"))} FROM (
    SELECT conv_id, i, b, s, {_best("u", *[_insert(q, "user") for q in _TO_USER])} AS u, a FROM (
      SELECT w.conv_id, r.i, {_best(_delete("b"))} AS b, {_best(_delete("s"), _keep("b", "s"))} AS s,
             {_best(_delete("u"), *[_keep(q, "u") for q in _TO_USER], *[_rerole(q, "user") for q in _TO_USER])} AS u,
             {_best(_delete("a"), _keep("u", "a"), _rerole("u", "assistant"))} AS a
      FROM walk w JOIN steps r ON r.conv_id = w.conv_id AND r.i = w.i + 1) t) t2),
ended AS (
  SELECT c.*, {_best("w.b", "w.a")} AS e FROM counts c JOIN walk w ON w.conv_id = c.conv_id AND w.i = c.last)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost,
       coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN ended USING (conv_id)
"""
