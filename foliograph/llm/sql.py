"""SQL counterparts, for DuckDB, of the queries SQL can express."""

from __future__ import annotations

from foliograph.functions.text import ENTITY_TYPES
from foliograph.llm.survivor import FILLERS, REFUSALS

SQL: dict[str, str] = {}


def _norm(x: str) -> str:
    s = f"regexp_replace(lower(trim(coalesce({x}, ''))), '^(the|a|an)\\s+', '')"
    s = f"regexp_replace({s}, '[‘’“”]', '''', 'g')"
    s = f"regexp_replace({s}, '[^a-z0-9''&./§\\- ]+', ' ', 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'), ' .')"


def _quoted(values: tuple[str, ...] | list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_SURVIVORS = rf"""
kept AS (SELECT * FROM entities WHERE key IN (SELECT key FROM entities GROUP BY key HAVING count(*) > 1)),
texts AS (SELECT *, trim(regexp_replace(definition, '\s+', ' ', 'g')) AS t FROM kept),
graded AS (
  SELECT key, entity_id, loaded_at, t, {_norm("t")} AS plain, string_split_regex(replace(replace(replace(lower(t), '. ', '.' || chr(1)), '! ', '!' || chr(1)), '? ', '?' || chr(1)), chr(1)) AS said
  FROM texts),
defs AS (
  SELECT key, 'definition' AS field, entity_id, loaded_at, nullif(t, '') AS value, coalesce(length(t), 0) AS size, 1.0 AS vote,
    CASE WHEN coalesce(t, '') = '' THEN 0 WHEN plain IN ({_quoted(FILLERS)}) THEN 1
         WHEN {" OR ".join(f"starts_with(lower(t), {_quoted([r])})" for r in REFUSALS)} OR NOT (starts_with(plain, key) AND NOT regexp_matches(substr(plain, length(key) + 1, 1), '[a-z0-9]') AND length(plain) > length(key) + 8) THEN 2
         WHEN NOT regexp_matches(t, '[.!?]["''”’)]?$') OR regexp_matches(t, '(\.\.|…)["''”’)]?$') THEN 3
         WHEN len(list_distinct(said)) < len(said) THEN 4 ELSE 5 END AS grade
  FROM graded),
types AS (
  SELECT key, 'type' AS field, entity_id, loaded_at, e.v AS value, 0 AS size, coalesce(mentions, 0)::DOUBLE AS vote,
    CASE WHEN e.v IS NULL THEN 0 WHEN e.v = 'Other' THEN 1 ELSE 2 END AS grade
  FROM kept LEFT JOIN (SELECT unnest([{_quoted(ENTITY_TYPES)}]) AS v) e ON lower(e.v) = lower(trim(type))),
saliences AS (
  SELECT key, 'salience' AS field, entity_id, loaded_at, s.v AS value, 0 AS size, 1.0 AS vote, coalesce(s.r, 0) AS grade
  FROM kept LEFT JOIN (VALUES ('mentioned', 1), ('secondary', 2), ('primary', 3)) s(v, r) ON s.v = lower(trim(salience))),
long AS (SELECT key, field, entity_id, loaded_at, value, size, vote, grade FROM defs UNION ALL SELECT key, field, entity_id, loaded_at, value, size, vote, grade FROM types
         UNION ALL SELECT key, field, entity_id, loaded_at, value, size, vote, grade FROM saliences),
aged AS (SELECT *, coalesce(pow(0.5, date_sub('second', loaded_at, (SELECT max(loaded_at) FROM entities)) / 86400.0 / 180), 0) AS decay FROM long),
summed AS (SELECT *, sum(vote) OVER (PARTITION BY key, field, value, grade, size) AS votes, round(sum(vote * decay) OVER (PARTITION BY key, field, value, grade, size), 9) AS recent FROM aged),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key, field ORDER BY grade DESC, size DESC, votes DESC, recent DESC, loaded_at DESC, entity_id) AS rn FROM summed),
won AS (SELECT key, field, value, entity_id FROM ranked WHERE rn = 1)
"""
SQL["p5_found"] = f"WITH {_SURVIVORS} SELECT key, field, entity_id FROM won"
SQL["p5_records"] = f"""WITH {_SURVIVORS} SELECT w.key,
    max(value) FILTER (field = 'definition') AS definition, max(entity_id) FILTER (field = 'definition') AS definition_from,
    max(value) FILTER (field = 'type') AS type, max(entity_id) FILTER (field = 'type') AS type_from,
    max(value) FILTER (field = 'salience') AS salience, max(entity_id) FILTER (field = 'salience') AS salience_from,
    any_value(m.mentions) AS mentions, any_value(m.n_rows) AS n_rows
  FROM won w JOIN (SELECT key, sum(mentions)::BIGINT AS mentions, count(*)::BIGINT AS n_rows FROM entities GROUP BY key) m ON m.key = w.key GROUP BY w.key"""
_SIZES = r"""sizes AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(n_tokens, len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\p{C}]+'))) AS total FROM documents)"""
SQL["p7_placed"] = f"""WITH {_SIZES} SELECT b.budget_id, s.source, s.doc_id, greatest(ceil(s.total / b.capacity_tokens), 1)::BIGINT AS pieces, s.total::BIGINT AS tokens,
    greatest(ceil(s.total / b.capacity_tokens), 1)::BIGINT AS different FROM sizes s, budgets b"""
SQL["p7_overfull"] = "SELECT budget_id, 0::BIGINT AS overfull FROM budgets"
