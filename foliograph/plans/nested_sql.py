"""SQL counterparts, for DuckDB, of reading nested records: elements whatever their shape, spelling or wrapping."""

from __future__ import annotations


def inner(x: str) -> str:
    """JSON value with a string that holds a list or object opened."""
    s = f"json_extract_string({x}, '$')"
    return f"(CASE WHEN json_type({x}) = 'VARCHAR' AND regexp_matches({s}, '^\\s*[\\[{{]') AND json_valid({s}) THEN TRY_CAST({s} AS JSON) ELSE {x} END)"


def listed(x: str) -> str:
    """List of the elements of a JSON value: those of a list, or the lone one; blank strings and nulls are none."""
    return f"""(CASE WHEN {x} IS NULL OR json_type({x}) = 'NULL' THEN []::JSON[] WHEN json_type({inner(x)}) = 'ARRAY' THEN TRY_CAST({inner(x)} AS JSON[])
      WHEN json_type({x}) = 'VARCHAR' AND trim(json_extract_string({x}, '$')) = '' THEN []::JSON[] ELSE [{x}] END)"""


def part(x: str, *names: str) -> str:
    """First of the fields that isn't null."""
    fields = [f"json_extract({inner(x)}, '$.{n}')" for n in names]
    return f"coalesce({', '.join(f'''CASE WHEN json_type({f}) <> 'NULL' THEN {f} END''' for f in fields)})"


def text(x: str, *names: str) -> str:
    """Field as text."""
    return f"json_extract_string({part(x, *names)}, '$')"


def _texts() -> str:
    steps = [r"""w0 AS (SELECT record_id, slug, regexp_replace(regexp_replace(payload, '^[\s\x{FEFF}]*(```[A-Za-z]*\s*)?', ''), '(\s*```)?\s*$', '') AS t FROM raw_documents)"""]
    for i in range(1, 6):
        steps.append(f"""w{i} AS (SELECT record_id, slug, CASE WHEN starts_with(t, '"') AND json_valid(t) THEN trim(json_extract_string(t, '$')) ELSE t END AS t FROM w{i - 1})""")
    steps.append(r"""texts AS MATERIALIZED (SELECT record_id, slug, TRY_CAST(t AS JSON) AS doc FROM w5 WHERE regexp_matches(t, '^[{\[]') AND json_valid(t))""")
    return ", ".join(steps)


def _level(name: str, source: str, keep: str, expr: str) -> str:
    """(…, item_no, e) of the elements of a list, nulls left out after numbering."""
    return f"{name} AS MATERIALIZED (SELECT {keep}, (i - 1)::INTEGER AS item_no, e FROM (SELECT {keep}, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM (SELECT {keep}, {expr} AS l FROM {source})) WHERE e IS NOT NULL AND json_type(e) <> 'NULL')"


def _children(name: str, names: list[str]) -> str:
    return _level(name, "sec", "record_id, slug, item_no AS parent_no", listed(part("e", *names))).replace("SELECT record_id, slug, item_no AS parent_no, (i", "SELECT record_id, slug, parent_no, (i").replace("FROM (SELECT record_id, slug, item_no AS parent_no, unnest", "FROM (SELECT record_id, slug, parent_no, unnest")


_GROUPED = f"""CASE WHEN len({listed(part("e", "child_sections", "childSections"))}) > 0 OR {part("e", "child_section_groups", "childSectionGroups")} IS NULL
      THEN {listed(part("e", "child_sections", "childSections"))}
      ELSE flatten(list_transform({listed(part("e", "child_section_groups", "childSectionGroups"))}, lambda g: CASE WHEN json_type(g) = 'NULL' THEN []::JSON[] ELSE {listed(part("g", "child_sections", "childSections"))} END)) END"""

ELEMENTS = ", ".join(
    [
        _texts(),
        f"docs AS (SELECT record_id, slug, unnest({listed('doc')}) AS doc FROM texts)",
        f"blocks AS MATERIALIZED (SELECT record_id, slug, {part('doc', 'sections', 'pages')} AS sections, {part('doc', 'enrichment', 'result')} AS b FROM docs)",
        _level("sec", "blocks", "record_id, slug", listed("sections")),
        _level("ents", "blocks", "record_id, slug", listed(part("b", "entities"))),
        _level("rel", "blocks", "record_id, slug", listed(part("b", "relationships"))),
        _children("kid", ["child_sections"]).replace(listed(part("e", "child_sections")), _GROUPED),
        _children("ref", ["cross_references", "crossReferences"]),
        _children("att", ["attachments"]),
        _children("evi", ["evidence"]).replace("FROM sec)", "FROM rel)"),
    ]
)

FOUND = f"""WITH {ELEMENTS} {" UNION ALL ".join(f"SELECT record_id, '{element}' AS element, {parent}::INTEGER AS parent_no, item_no FROM {table}" for element, table, parent in (
    ("section", "sec", "-1"), ("entity", "ents", "-1"), ("relationship", "rel", "-1"), ("child_section", "kid", "parent_no"), ("cross_reference", "ref", "parent_no"), ("attachment", "att", "parent_no"), ("evidence", "evi", "parent_no")))}"""  # fmt: skip


def table(element: str, source: str, columns: list[tuple[str, ...]], parent: str | None = None) -> str:
    """One flat table: keys, ordinal and fields as text; of several spellings the first names the column."""
    own = f"record_id || ':{element}:' || {'parent_no || chr(58) || ' if parent else ''}item_no"
    up = f"record_id || ':{parent}:' || parent_no" if parent else "NULL::VARCHAR"
    return f"WITH {ELEMENTS} SELECT record_id, {own} AS node_key, {up} AS parent_key, item_no, {', '.join(f'{text("e", *names)} AS {chr(34)}{names[0]}{chr(34)}' for names in columns)} FROM {source}"


def values(element: str, source: str, parent: str) -> str:
    """The flat table of elements that are no objects."""
    return f"""WITH {ELEMENTS} SELECT record_id, record_id || ':{element}:' || parent_no || ':' || item_no AS node_key, record_id || ':{parent}:' || parent_no AS parent_key, item_no,
      json_extract_string(e, '$') AS value FROM {source}"""


def organisations() -> str:
    """The organisations of manuals: a list in an object that isn't one."""
    level = _level("org", "docs", "record_id, slug", listed(part(part("doc", "manual"), "organisations")))
    return f"""WITH {ELEMENTS}, {level} SELECT record_id, record_id || ':manual.organisations:' || item_no AS node_key, NULL::VARCHAR AS parent_key, item_no, json_extract_string(e, '$') AS value FROM org"""
