"""SQL of the queries that SQL can express, written for DuckDB: its patterns have no lookarounds, so
bounds of a match are consumed (account numbers) or tested on whole runs (social security numbers).
"""

from __future__ import annotations

from tallyguard.llm.pii import DIGITS_AND_LETTERS, WORDS

PII_KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
# What is taken from the text, and which of it counts as a match.
PII_TAKEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(^|[^A-Za-z0-9])[A-Z]{2}[0-9]{2}( ?[A-Z0-9])+",
    "ssn": r"[0-9-]+",
}


def _near(kind: str) -> str:
    return f"regexp_matches(lower(before || ' ' || after), '(^|[^a-z])({WORDS[kind]})([^a-z]|$)')"


def pii_sql(table: str = "documents") -> str:
    taken = " UNION ALL ".join(
        f"SELECT rid, {rank} AS rank, '{kind}' AS kind, regexp_extract_all(text, '{PII_TAKEN[kind]}') AS v,"
        f" string_split_regex(text, '{PII_TAKEN[kind]}') AS g FROM docs"
        for rank, kind in enumerate(PII_KINDS)
    )
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in PII_KINDS[:4])
    place = "kind || ':' || s || ':' || e"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {table}),
taken AS ({taken}),
runs AS (SELECT rid, rank, kind, generate_subscripts(v, 1) AS j, unnest(v) AS raw, unnest(g[:len(v)]) AS gap
         FROM taken WHERE len(v) > 0),
ended AS (SELECT *, sum(length(gap) + length(raw)) OVER (PARTITION BY rid, rank ORDER BY j) AS e FROM runs),
named AS (SELECT rid, rank, kind, e,
                 CASE WHEN kind = 'iban' THEN regexp_replace(raw, '^[^A-Za-z0-9]', '') ELSE raw END AS value FROM ended
          WHERE kind <> 'ssn' OR regexp_full_match(raw, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}')),
placed AS (SELECT *, e - length(value) AS s FROM named),
bounded AS (SELECT p.*, text, coalesce(lag(e) OVER w, 0) AS low, coalesce(lead(s) OVER w, length(text)) AS high
            FROM placed p JOIN docs USING (rid) WINDOW w AS (PARTITION BY rid, rank ORDER BY s)),
seen AS (SELECT rid, rank, kind, s::BIGINT AS s, e::BIGINT AS e, value,
                regexp_replace(value, '[^0-9]', '', 'g') AS d, regexp_replace(value, '[^0-9A-Z]', '', 'g') AS code,
                substring(text, greatest(low, s - 40)::BIGINT + 1, (s - greatest(low, s - 40))::BIGINT) AS before,
                substring(text, e::BIGINT + 1, least(40, high - e)::BIGINT) AS after FROM bounded),
kept AS (
  SELECT * FROM seen WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len([x FOR x IN string_split(value, '.')
                        IF length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255]) = 0
    WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND list_sum(
      [CASE WHEN (length(d) - i) % 2 = 0 THEN d[i]::INT WHEN d[i]::INT > 4 THEN 2 * d[i]::INT - 9
            ELSE 2 * d[i]::INT END FOR i IN range(1, length(d) + 1)]) % 10 = 0
    WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
    WHEN 'iban' THEN length(code) BETWEEN 15 AND 34 AND list_reduce(
      [instr('{DIGITS_AND_LETTERS}', x) - 1 FOR x IN string_split(code[5:] || code[:4], '')],
      lambda a, x: (a * (CASE WHEN x > 9 THEN 100 ELSE 10 END) + x) % 97) = 1
    ELSE {_near("ssn")} AND NOT regexp_matches(value, '^(000|666|9)|-00-|-0000$') END),
told AS (SELECT rid, {counts}, string_agg({place}, ',' ORDER BY s, rank) FILTER (rank < 4) AS base,
                string_agg({place}, ',' ORDER BY s, rank) AS spans FROM kept GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in PII_KINDS[:4])},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (rid)"""


SQL = {"op1_pii": pii_sql()}
