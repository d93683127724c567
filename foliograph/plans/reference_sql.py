"""SQL counterparts, for DuckDB, of the reference queries."""

from __future__ import annotations

from foliograph.functions.text import RELATIONSHIP_TYPES
from foliograph.plans import nested_sql
from foliograph.plans.problems_sql import _segment


def norm(x: str) -> str:
    s = f"regexp_replace(lower(trim(coalesce({x}, ''))), '^(the|a|an)\\s+', '')"
    s = f"regexp_replace({s}, '[‘’“”]', '''', 'g')"
    s = f"regexp_replace({s}, '[^a-z0-9''&./§\\- ]+', ' ', 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'), ' .')"


def rank(x: str) -> str:
    return f"(CASE {x} WHEN 'primary' THEN 3 WHEN 'secondary' THEN 2 WHEN 'mentioned' THEN 1 ELSE 0 END)"


def named(r: str) -> str:
    return f"(CASE {r} WHEN 3 THEN 'primary' WHEN 2 THEN 'secondary' WHEN 1 THEN 'mentioned' END)"


def words(x: str) -> str:
    return f"len(regexp_extract_all(coalesce({x}, ''), '\\S+'))"


_PAGES = f"""pages AS (
  SELECT node_id, x.* FROM (SELECT node_id, unnest(x) AS x FROM (
    SELECT {_segment("base_path")} AS node_id, [max_by(s, struct_pack(a := crawled_at, b := page_id))] AS x FROM sections s GROUP BY 1)) t
  WHERE x.error IS NULL AND node_id IS NOT NULL)"""
_HREF = f"""CASE WHEN regexp_matches(regexp_replace(regexp_replace(trim(x.href), '[?#].*$', ''), '/+$', ''),
  '^([A-Za-z]+[0-9]+[A-Za-z]?|((https?:)?//www[.]manuals[.]example)?/(internal-manuals|guidance)/[^/]+/(.+/)?[^/]+)$', 'i') THEN {_segment("x.href")} END"""
_XREF = f"""{_PAGES}, xref AS (
  SELECT DISTINCT src, dst FROM (SELECT node_id AS src, {_HREF} AS dst FROM (SELECT node_id, unnest(cross_references) AS x FROM pages))
  WHERE src <> dst AND dst IN (SELECT node_id FROM pages))"""
_MENTION = f"""{_PAGES}, mention AS (
  SELECT DISTINCT src, dst FROM (SELECT key AS src, {_segment("trim(x, ' []' || chr(160))")} AS dst FROM (SELECT key, unnest(section_ids) AS x FROM entities WHERE key IS NOT NULL))
  WHERE dst IN (SELECT node_id FROM pages))"""
_QUOTED_TYPES = ", ".join(f"'{t}'" for t in RELATIONSHIP_TYPES)
_RELS = f"""{nested_sql.ELEMENTS}, named_rel AS (
  SELECT record_id, slug, item_no, {norm(nested_sql.text("e", "source"))} AS s, {nested_sql.text("e", "type")} AS type, {norm(nested_sql.text("e", "target"))} AS t,
    list_transform(list_filter({nested_sql.listed(nested_sql.part("e", "section_ids"))}, lambda x: json_type(x) <> 'NULL'), lambda x: json_extract_string(x, '$')) AS section_ids FROM rel),
loaded AS (
  SELECT slug, key, min(struct_pack(t := loaded_at, i := entity_id)) AS first, list_distinct(list_filter(flatten(list(coalesce(aliases, []))), lambda x: x <> '')) AS al
  FROM entities WHERE key IS NOT NULL GROUP BY 1, 2),
alias_of AS (SELECT slug, {norm("a")} AS n, arg_min(key, struct_pack(f := first, k := key)) AS key FROM (SELECT slug, key, first, unnest(al) AS a FROM loaded) WHERE {norm("a")} <> '' GROUP BY 1, 2),
name_of AS (SELECT slug, n, arg_min(key, struct_pack(o := o, k := key)) AS key FROM (SELECT slug, key AS n, 0 AS o, key FROM loaded UNION ALL SELECT slug, n, 1, key FROM alias_of) GROUP BY 1, 2),
rels AS MATERIALIZED (
  SELECT r.record_id, r.slug, r.item_no, a.key AS source_key, r.type, b.key AS target_key, r.section_ids,
    coalesce(a.key <> b.key AND r.type IN ({_QUOTED_TYPES}), false) AS ok
  FROM named_rel r LEFT JOIN name_of a ON a.slug = r.slug AND a.n = r.s LEFT JOIN name_of b ON b.slug = r.slug AND b.n = r.t),
quotes AS (SELECT r.record_id, r.slug, r.item_no, r.source_key, r.type, r.target_key, v.item_no AS nth, trim(json_extract_string(v.e, '$')) AS q FROM rels r JOIN evi v ON v.record_id = r.record_id AND v.parent_no = r.item_no WHERE r.ok)"""


def _folded(name: str, by: str) -> str:
    """Relationship fold per document or record."""
    key = f"{by}, source_key, type, target_key"
    same = " AND ".join(f"f.{c} = g.{c}" for c in [*by.split(", "), "source_key", "type", "target_key"])
    return f"""{name} AS (
  SELECT f.*, coalesce(g.evidence, []) AS evidence FROM (
    SELECT {key}, count(*)::BIGINT AS mentions, list_sort(list_distinct(list_filter(flatten(list(coalesce(section_ids, []))), lambda x: x <> ''))) AS section_ids FROM rels WHERE ok GROUP BY ALL) f
  LEFT JOIN (SELECT {key}, list(q ORDER BY first) AS evidence FROM (
    SELECT {key}, q, min(struct_pack(r := record_id, i := item_no, p := nth)) AS first FROM quotes WHERE q <> '' GROUP BY ALL) GROUP BY {key}) g ON {same})"""


_EDGES = f"""{_RELS}, {_folded("loads", "record_id, slug")}, edges AS MATERIALIZED (
  SELECT source_key AS src, type, target_key AS dst, list_sort(list_distinct(flatten(list(evidence)))) AS evidence, arg_max(mentions, record_id) AS mentions, arg_min(slug || '.json', record_id) AS created_from
  FROM loads GROUP BY 1, 2, 3)"""
_BOTH_WAYS = """both_ways AS (SELECT src AS node, dst AS other, type, mentions FROM edges UNION ALL SELECT dst, src, type, mentions FROM edges WHERE src <> dst)"""
_CO = """pairs AS (SELECT DISTINCT e.src, e.dst, a.dst AS node_id FROM edges e JOIN mention a ON a.src = e.src JOIN mention b ON b.src = e.dst AND b.dst = a.dst)"""
_DISCUSS = f"""discuss AS (
  SELECT slug, key, max({rank("lower(trim(salience))")}) AS r, sum(mentions)::BIGINT AS mentions FROM entities WHERE key IS NOT NULL GROUP BY 1, 2)"""
_PROPS = f"""{_PAGES}, props AS (
  SELECT *, row_number() OVER (PARTITION BY slug ORDER BY coalesce(section_id, ''), coalesce(base_path, ''), page_id) - 1 AS position,
    coalesce(nullif(section_id, ''), base_path) AS sid FROM pages)"""
_UPSERT = """upsert AS (
  SELECT key, arg_max(trim(coalesce(name, '')), struct_pack(n := length(trim(coalesce(name, ''))), t := -epoch_us(loaded_at), i := -entity_id)) AS name,
    arg_min(type, struct_pack(t := loaded_at, i := entity_id)) FILTER (type IS NOT NULL) AS type,
    arg_max(trim(coalesce(definition, '')), struct_pack(n := length(trim(coalesce(definition, ''))), t := -epoch_us(loaded_at), i := -entity_id)) AS definition,
    array_to_string(list_sort(list_distinct(list_filter(flatten(list(coalesce(aliases, []))), lambda x: x <> ''))), '; ') AS aliases,
    arg_min(created_from, struct_pack(t := loaded_at, i := entity_id)) AS created_from, count(*)::BIGINT AS loads
  FROM entities WHERE key IS NOT NULL GROUP BY key)"""
_SIZED = f"""{_PAGES}, sized AS (
  SELECT slug, page_id, row_number() OVER (PARTITION BY slug ORDER BY coalesce(section_id, ''), coalesce(base_path, ''), page_id) - 1 AS pos, {words("text")} AS w
  FROM pages WHERE NOT coalesce(is_contents_page, false) AND {words("coalesce(text, '') || ' ' || coalesce(description, '')")} >= 25),
walk(slug, pos, w, chunk, used, sealed) AS (
  SELECT slug, pos, w, CASE WHEN w > 400 THEN (w + 399) // 400 - 1 ELSE 0 END, w, w > 400 FROM sized WHERE pos = 0
  UNION ALL
  SELECT s.slug, s.pos, s.w,
    CASE WHEN s.w > 400 THEN k.chunk + (s.w + 399) // 400 WHEN k.sealed OR (k.used + s.w > 400 AND k.used > 0) THEN k.chunk + 1 ELSE k.chunk END,
    CASE WHEN s.w > 400 THEN s.w WHEN k.sealed OR (k.used + s.w > 400 AND k.used > 0) THEN s.w ELSE k.used + s.w END, s.w > 400
  FROM walk k JOIN sized s ON s.slug = k.slug AND s.pos = k.pos + 1),
pieces AS (
  SELECT slug, pos::INTEGER AS pos, p::INTEGER AS piece_no, (p * 400)::INTEGER AS first_word, (CASE WHEN w > 400 THEN least(400, w - p * 400) ELSE w END)::INTEGER AS n_words,
    (CASE WHEN w > 400 THEN chunk - (w + 399) // 400 + 1 + p ELSE chunk END)::INTEGER AS chunk_no
  FROM (SELECT *, unnest(range(0, CASE WHEN w > 400 THEN (w + 399) // 400 ELSE 1 END)) AS p FROM walk))"""
_KNOWN = f"""known AS (SELECT DISTINCT slug, section_id FROM sections WHERE section_id IS NOT NULL),
mentions AS (
  SELECT e.* REPLACE (CASE WHEN e.slug IN (SELECT slug FROM known) THEN list_filter(e.section_ids, lambda x: list_contains(k.ids, x)) ELSE e.section_ids END AS section_ids), {norm("e.name")} AS key
  FROM extractions e LEFT JOIN (SELECT slug, list(section_id) AS ids FROM known GROUP BY slug) k ON k.slug = e.slug),
ent AS (
  SELECT slug, key, best.name AS name, type, best.def AS definition, list_filter(al, lambda a: {norm("a")} <> key) AS aliases, sids AS section_ids,
    coalesce({named("r")}, coalesce(first_s, 'mentioned')) AS salience, mentions
  FROM (
    SELECT slug, key, arg_max(struct_pack(name := trim(name), def := trim(coalesce(definition, ''))), struct_pack(n := length(trim(coalesce(definition, ''))), c := -chunk_no, m := -mention_id)) AS best,
      arg_min(coalesce(nullif(type, ''), 'Other'), struct_pack(c := chunk_no, m := mention_id)) AS type,
      list_sort(list_distinct(list_filter(list_transform(flatten(list(coalesce(aliases, []))), lambda x: trim(x)), lambda x: x <> ''))) AS al,
      list_sort(list_distinct(list_filter(flatten(list(coalesce(section_ids, []))), lambda x: x <> ''))) AS sids,
      max({rank("salience")}) AS r, arg_min(struct_pack(s := nullif(salience, '')), struct_pack(c := chunk_no, m := mention_id)).s AS first_s, count(*)::BIGINT AS mentions
    FROM mentions WHERE length(key) >= 2 GROUP BY slug, key))"""
_UNIT = "list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[])"

def _rounds(n: int, links: str = "xref", weight: str = "1", begin: str = "") -> str:
    """Rounds of PageRank over the table of links, written out: aggregation over the whole of the round before is plainer
    this way than in recursion."""
    out = [f"{begin or _XREF}, nodes AS MATERIALIZED (SELECT src AS node FROM {links} UNION SELECT dst FROM {links}), size AS MATERIALIZED (SELECT count(*)::DOUBLE AS n FROM nodes)"]
    out.append(f"outs AS MATERIALIZED (SELECT src, sum({weight})::DOUBLE AS k FROM {links} GROUP BY src), steps AS MATERIALIZED (SELECT x.src, x.dst, {weight} / o.k AS share FROM {links} x JOIN outs o ON o.src = x.src)")
    out.append("r0 AS (SELECT node, 1 / n AS r FROM nodes, size)")
    for i in range(1, n + 1):
        out.append(
            f"r{i} AS MATERIALIZED (SELECT m.node, (SELECT 0.15 / n + 0.85 * coalesce((SELECT sum(r) FROM r{i - 1} WHERE node NOT IN (SELECT src FROM outs)), 0) / n FROM size) + 0.85 * coalesce(g.s, 0) AS r "
            f"FROM nodes m LEFT JOIN (SELECT t.dst, sum(t.share * p.r) AS s FROM steps t JOIN r{i - 1} p ON p.node = t.src GROUP BY t.dst) g ON g.dst = m.node)"
        )
    return ", ".join(out)


_PROJECTED = f"""{_EDGES}, {_UPSERT}, plain AS (SELECT key FROM upsert WHERE type NOT IN ('Organisation', 'Jurisdiction')), projected AS MATERIALIZED (
  SELECT src, dst, sum(greatest(coalesce(nullif(mentions, 0), 1), 1))::DOUBLE AS weight FROM edges
  WHERE type NOT IN ('RELATED_TO', 'REFERENCES', 'EXAMPLE_OF', 'ADMINISTERED_BY', 'GOVERNED_BY') AND src IN (SELECT key FROM plain) AND dst IN (SELECT key FROM plain) GROUP BY 1, 2)"""
_WHOLE = f"""{_EDGES}, {_UPSERT}, whole AS MATERIALIZED (SELECT src, dst, sum(greatest(coalesce(nullif(mentions, 0), 1), 1))::DOUBLE AS weight FROM edges GROUP BY 1, 2)"""
_COMPONENT = f"""{_XREF}, both_ways AS (SELECT src, dst FROM xref UNION SELECT dst, src FROM xref),
reach(a, b) AS (SELECT src, dst FROM both_ways UNION SELECT r.a, e.dst FROM reach r JOIN both_ways e ON e.src = r.b),
comp AS (SELECT a AS node, least(a, min(b)) AS component FROM reach GROUP BY a)"""

SQL: dict[str, str] = {
    "o01_first_seen": "SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
    "o02_listing": "SELECT slug, title, format FROM manuals WHERE list_contains(organisations, 'Revenue Office') ORDER BY title, slug",
    "o05_incomplete": "SELECT slug, count(*)::BIGINT AS reported, count(*) FILTER (error IS NULL)::BIGINT AS fetched FROM sections GROUP BY slug HAVING count(*) FILTER (error IS NULL) < count(*)",
    "o16_clean": "SELECT doc_id, regexp_replace(regexp_replace(text, '[ \\t\\x{00A0}\\x{200B}]+', ' ', 'g'), '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g') AS text FROM documents",
    "o18_slug": "SELECT page_id, CASE WHEN url IS NULL THEN 'manual' ELSE coalesce(nullif(split_part(regexp_replace(url, '/+$', ''), '/', -1), ''), 'manual') END AS slug FROM sections",
    "o19_heading": """SELECT page_id, CASE WHEN coalesce(section_id, '') <> '' AND starts_with(upper(title), upper(section_id))
        AND trim(regexp_replace(substr(title, length(section_id) + 1), '^[ \\-–—:]+', '')) <> ''
        THEN trim(regexp_replace(substr(title, length(section_id) + 1), '^[ \\-–—:]+', '')) ELSE title END AS heading FROM sections""",
    "o20_measures": f"""SELECT page_id, length(coalesce(text, ''))::INTEGER AS chars, {words("text")}::INTEGER AS words, (coalesce(len(child_sections), 0) > 0 AND coalesce(text, '') = '') AS contents_page,
        coalesce(length(coalesce(text, '')) = char_count, false) AS chars_agree FROM sections""",
    "o21_children": """SELECT page_id, (i - 1)::INTEGER AS pos, c.section_id AS section_id, c.title AS title, c.base_path AS base_path, nullif(c.group_title, '') AS group_title
        FROM (SELECT page_id, unnest(child_sections) AS c, generate_subscripts(child_sections, 1) AS i FROM sections)""",
    "o22_norm": f"SELECT mention_id, {norm('name')} AS key FROM extractions",
    "o23_eligible": f"""SELECT page_id, {words("text")}::INTEGER AS words FROM sections WHERE error IS NULL AND NOT coalesce(is_contents_page, false)
        AND {words("coalesce(text, '') || ' ' || coalesce(description, '')")} >= 25""",
    "o24_props": f"""WITH {_PROPS} SELECT page_id, slug, sid AS section_id, coalesce(nullif(title, ''), nullif(heading, ''), '') AS title, coalesce(heading, '') AS heading,
        coalesce(is_contents_page, false) AS is_contents_page, coalesce(withdrawn, false) AS withdrawn, position::INTEGER AS position FROM props""",
    "o25_embedding_text": f"""WITH {_PAGES} SELECT page_id, CASE WHEN coalesce(heading, '') = '' THEN coalesce(text, '') ELSE heading || chr(10) || chr(10) || coalesce(text, '') END AS text
        FROM pages WHERE NOT is_contents_page AND {words("text")} >= 10""",
    "o09_content_key": "SELECT doc_id, left(sha256('m' || chr(0) || '64' || chr(0) || coalesce(text, '')), 32) AS key FROM documents",
    "o27_salvage": "SELECT record_id, json_valid(payload) AS usable FROM raw_documents",
    "o29_ids": "SELECT mention_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(section_ids, lambda x: trim(x, ' ' || chr(160))), lambda x: x <> ''))), ',') AS ids FROM extractions",
    "o30_snippets": """SELECT doc_id, left(text, 400) AS snippet, CASE WHEN length(s) > 40 THEN rtrim(left(s, 39)) || '…' ELSE s END AS label, length(text) > 12000 AS truncated
        FROM (SELECT doc_id, text, trim(regexp_replace(text, '[\\s\\x{00A0}\\x{2007}\\x{202F}\\x{2028}\\x{2029}\\x{3000}]+', ' ', 'g')) AS s FROM documents)""",
    "o33_quotes_held": """SELECT mention_id, array_to_string(list_sort(held), '; ') AS held FROM (
        SELECT mention_id, list_filter(list_distinct(list_concat([name], coalesce(aliases, []))), lambda q: contains(definition, q)) AS held FROM extractions) WHERE len(held) > 0""",
    "o35_guarded_sql": "SELECT format, count(*)::BIGINT AS n FROM manuals GROUP BY format",
    "o36_chunks": f"WITH RECURSIVE {_SIZED} SELECT slug, pos, piece_no, first_word, n_words, chunk_no FROM pieces",
    "o13_dry_run": f"""WITH RECURSIVE {_SIZED} SELECT slug, count(DISTINCT pos)::BIGINT AS sections, count(DISTINCT chunk_no)::BIGINT AS chunks, sum(n_words)::BIGINT AS words FROM pieces GROUP BY slug""",
    "o40_first_chunks": f"WITH RECURSIVE {_SIZED} SELECT slug, pos, piece_no, first_word, n_words, chunk_no FROM pieces WHERE chunk_no < 3",
    "o37_halves": f"""WITH RECURSIVE {_SIZED}, grouped AS (
        SELECT slug || '#' || chunk_no AS chunk, (pos - min(pos) OVER (PARTITION BY slug, chunk_no))::INTEGER AS pos, n_words, count(*) OVER (PARTITION BY slug, chunk_no) AS n FROM pieces)
        SELECT chunk, pos, 0 AS first_word, n_words, (CASE WHEN pos < n // 2 THEN 0 ELSE 1 END)::INTEGER AS half FROM grouped WHERE n > 1
        UNION ALL SELECT chunk, pos, (CASE WHEN h = 0 THEN 0 ELSE n_words // 2 END)::INTEGER, (CASE WHEN h = 0 THEN n_words // 2 ELSE n_words - n_words // 2 END)::INTEGER, h::INTEGER
        FROM (SELECT *, unnest([0, 1]) AS h FROM grouped WHERE n = 1 AND n_words >= 200)""",
    "o45_cache_hits": """SELECT d.doc_id, l.result FROM documents d JOIN (SELECT doc_id, arg_max(lower(kind), struct_pack(t := labelled_at, a := coalesce(annotator, ''))) AS result
        FROM doc_labels GROUP BY doc_id) l ON l.doc_id = d.doc_id""",
    "o45_cache_todo": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM doc_labels)",
    "o56_entity_fold": f"""WITH {_KNOWN} SELECT slug, key, name, type, definition, array_to_string(aliases, '; ') AS aliases, array_to_string(section_ids, '; ') AS section_ids, salience, mentions FROM ent""",
    "o44_alias_resolution": f"""WITH {_KNOWN}, al AS (SELECT DISTINCT slug, unnest(aliases) AS alias FROM ent),
        amap AS (SELECT slug, {norm("a")} AS ak, min(key) AS key FROM (SELECT slug, key, unnest(aliases) AS a FROM ent) WHERE {norm("a")} <> '' GROUP BY 1, 2)
        SELECT al.slug, al.alias, coalesce(e.key, m.key) AS resolved_key FROM al LEFT JOIN ent e ON e.slug = al.slug AND e.key = {norm("al.alias")}
        LEFT JOIN amap m ON m.slug = al.slug AND m.ak = {norm("al.alias")}""",
    "o59_type_counts": "SELECT slug, string_agg(type || ':' || n, ',' ORDER BY n DESC, type) AS counts FROM (SELECT slug, type, count(*) AS n FROM extractions WHERE type IS NOT NULL GROUP BY 1, 2) GROUP BY slug",
    "o60_totals": """SELECT coalesce(slug, '(all)') AS slug, count(*)::BIGINT AS fetches, count(error)::BIGINT AS failed, coalesce(sum(word_count), 0)::BIGINT AS words, coalesce(sum(char_count), 0)::BIGINT AS chars,
        coalesce(sum(len(attachments)), 0)::BIGINT AS attachments FROM sections GROUP BY ROLLUP (slug)""",
    "o61_entity_upsert": f"WITH {_UPSERT} SELECT key, name, type, definition, aliases, created_from, loads FROM upsert",
    "o62_discusses": f"WITH {_DISCUSS} SELECT slug, key, coalesce({named('r')}, '') AS salience, r::INTEGER AS salience_rank, mentions FROM discuss",
    "o69_entity_order": f"""WITH {_DISCUSS}, {_UPSERT} SELECT d.slug, (row_number() OVER (PARTITION BY d.slug ORDER BY d.r DESC, d.mentions DESC, lower(u.name), d.key) - 1)::INTEGER AS place, d.key, u.name, d.mentions
        FROM discuss d JOIN upsert u ON u.key = d.key""",
    "o93_back_pointers": f"""WITH {_KNOWN}, {_RELS}, {_folded("fold", "slug")},
        keyed AS (SELECT slug, section_id, string_agg(DISTINCT key, '; ' ORDER BY key) AS k FROM (SELECT slug, key, unnest(section_ids) AS section_id FROM ent) GROUP BY 1, 2),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY mentions DESC, lower(source_key), type, lower(target_key), source_key, target_key) - 1 AS place FROM fold),
        refs AS (SELECT slug, section_id, array_to_string(list_sort(list(DISTINCT place)), ',') AS p FROM (SELECT slug, place, unnest(section_ids) AS section_id FROM numbered) GROUP BY 1, 2)
        SELECT coalesce(a.slug, b.slug) AS slug, coalesce(a.section_id, b.section_id) AS section_id, coalesce(k, '') AS entity_mentions, coalesce(p, '') AS relationship_refs
        FROM keyed a FULL JOIN refs b ON b.slug = a.slug AND b.section_id = a.section_id""",
    "o39_next": f"WITH {_PROPS} SELECT slug, src, dst FROM (SELECT slug, sid AS src, lead(sid) OVER (PARTITION BY slug ORDER BY position) AS dst FROM props) WHERE dst IS NOT NULL",
    "o41_child_edges": f"""WITH {_PAGES} SELECT DISTINCT src, dst FROM (SELECT node_id AS src, coalesce({_segment("x.section_id")}, {_segment("x.base_path")}) AS dst
        FROM (SELECT node_id, unnest(child_sections) AS x FROM pages)) WHERE src <> dst AND dst IN (SELECT node_id FROM pages)""",
    "o42_cross_references": f"WITH {_XREF} SELECT src, dst FROM xref",
    "o46_mentioned_in": f"WITH {_MENTION} SELECT src, dst FROM mention",
    "o10_attachments": f"""WITH {_PAGES} SELECT a.url AS url, max(struct_pack(t := a.title, c := a.content_type)).t AS title, max(struct_pack(t := a.title, c := a.content_type)).c AS content_type
        FROM (SELECT unnest(attachments) AS a FROM pages) WHERE a.url IS NOT NULL GROUP BY 1""",
    "o94_not_unique": f"SELECT {_segment('base_path')} AS key, count(*)::BIGINT AS n FROM sections GROUP BY 1 HAVING count(*) > 1",
    "o95_format_tally": "SELECT format, count(*)::BIGINT AS n, (row_number() OVER (ORDER BY count(*) DESC, format NULLS FIRST))::INTEGER AS rank FROM manuals GROUP BY format",
    "o68_weights": "SELECT slug AS src, key AS dst, sum(greatest(coalesce(nullif(mentions, 0), 1), 1))::DOUBLE AS weight FROM entities WHERE slug <> key GROUP BY 1, 2",
    "o79_pagerank": f"WITH {_rounds(10)} SELECT node, round(r / (SELECT max(r) FROM r10), 6) AS pagerank FROM r10",
    "o80_components": f"""WITH RECURSIVE {_COMPONENT}, sizes AS (SELECT component, count(*) AS n FROM comp GROUP BY 1),
        numbered AS (SELECT component, n, row_number() OVER (ORDER BY n DESC, component) - 1 AS k FROM sizes)
        SELECT node, k::BIGINT AS component, n::BIGINT AS component_size FROM comp JOIN numbered USING (component)""",
    "o67_component_sizes": f"WITH RECURSIVE {_COMPONENT} SELECT component, count(*)::BIGINT AS n FROM comp GROUP BY 1",
    "o78_projection": f"WITH {_PROJECTED} SELECT src, dst, weight FROM projected",
    "o72_nearest": f"""SELECT e.vec_id, round({_UNIT}, 4) AS score FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY {_UNIT} DESC, e.vec_id LIMIT 10""",
    "o72_nearest_of_each": f"""SELECT query_id, vec_id, round(s, 4) AS score, rank::INTEGER AS rank FROM (SELECT q.vec_id AS query_id, e.vec_id, round({_UNIT}, 12) AS s,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY round({_UNIT}, 12) DESC, e.vec_id) AS rank FROM embeddings q JOIN embeddings e ON e.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0) WHERE rank <= 10""",
    "o47_section_hits": f"""WITH {_MENTION}, {_UPSERT}, hits AS (SELECT p.node_id AS id, {_UNIT} AS s FROM embeddings e JOIN pages p ON p.page_id = e.vec_id,
          (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY s DESC, id LIMIT 10)
        SELECT h.id, round(h.s, 4) AS score, p.title, p.slug AS manual, coalesce(n.entities, '') AS entities, left(coalesce(p.text, ''), 400) AS text
        FROM hits h JOIN pages p ON p.node_id = h.id
        LEFT JOIN (SELECT m.dst, array_to_string(list_sort(list(DISTINCT u.name))[1:10], '; ') AS entities FROM mention m JOIN upsert u ON u.key = m.src GROUP BY m.dst) n ON n.dst = h.id""",
    "o48_entity_neighbours": f"WITH {_DISCUSS} SELECT key, string_agg(DISTINCT slug, ',' ORDER BY slug) AS manuals, sum(mentions)::BIGINT AS mentions FROM discuss GROUP BY key",
    "o50_strongest_edges": f"""WITH {_EDGES}, {_BOTH_WAYS}
        SELECT node, other, type, mentions, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY mentions DESC, other, type) AS rank FROM both_ways) WHERE rank <= 25""",
    "o49_evidence_sections": f"""WITH {_MENTION}, {_EDGES}, {_CO} SELECT e.src, e.dst, e.type, min(p.node_id) AS node_id FROM edges e JOIN pairs c ON c.src = e.src AND c.dst = e.dst
        JOIN pages p ON p.node_id = c.node_id WHERE len(list_filter(e.evidence, lambda q: contains(p.text, q))) > 0 GROUP BY 1, 2, 3""",
    "o51_ego_network": f"""WITH {_EDGES}, {_UPSERT}, {_BOTH_WAYS}
        SELECT node, other, count(*)::BIGINT AS relations, sum(mentions)::BIGINT AS mentions, string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM both_ways
        WHERE type NOT IN ('RELATED_TO', 'REFERENCES', 'EXAMPLE_OF', 'ADMINISTERED_BY', 'GOVERNED_BY') AND other IN (SELECT key FROM upsert WHERE type NOT IN ('Organisation', 'Jurisdiction')) GROUP BY 1, 2""",
    "o52_read_sections": f"""WITH {_PAGES}, wanted AS (SELECT DISTINCT coalesce({_segment("x.section_id")}, {_segment("x.base_path")}) AS node_id FROM (SELECT unnest(child_sections) AS x FROM sections))
        SELECT w.node_id, least(12000, length(coalesce(p.text, '')))::INTEGER AS chars, length(coalesce(p.text, '')) > 12000 AS truncated, p.node_id IS NOT NULL AS found
        FROM wanted w LEFT JOIN pages p ON p.node_id = w.node_id WHERE w.node_id IS NOT NULL""",
    "o54_answer_subgraph": f"""WITH {_EDGES}, {_DISCUSS}, best AS (SELECT key FROM discuss GROUP BY key ORDER BY sum(mentions) DESC, key LIMIT 100)
        SELECT src, dst, type, mentions FROM edges WHERE src IN (SELECT key FROM best) AND dst IN (SELECT key FROM best) ORDER BY mentions DESC, src, type, dst LIMIT 50""",
}
SQL["o65_summary"] = f"""WITH {_MENTION}, {_UPSERT}, {_DISCUSS}, {_EDGES}, child AS ({f'SELECT DISTINCT src, dst FROM (SELECT node_id AS src, coalesce({_segment("x.section_id")}, {_segment("x.base_path")}) AS dst FROM (SELECT node_id, unnest(child_sections) AS x FROM pages)) WHERE src <> dst AND dst IN (SELECT node_id FROM pages)'}),
    links AS (SELECT DISTINCT src, dst FROM (SELECT node_id AS src, {_HREF} AS dst FROM (SELECT node_id, unnest(cross_references) AS x FROM pages)) WHERE src <> dst AND dst IN (SELECT node_id FROM pages)),
    files AS (SELECT DISTINCT node_id, a.url AS url FROM (SELECT node_id, unnest(attachments) AS a FROM pages) WHERE a.url IS NOT NULL)
    SELECT 'documents' AS table_name, count(*)::BIGINT AS n FROM manuals UNION ALL SELECT 'sections', count(*) FROM pages UNION ALL SELECT 'attachments', count(DISTINCT url) FROM files
    UNION ALL SELECT 'entities', count(*) FROM upsert UNION ALL SELECT 'has_section', count(*) FROM pages UNION ALL SELECT 'next', count(*) - count(DISTINCT slug) FROM pages
    UNION ALL SELECT 'has_child', count(*) FROM child UNION ALL SELECT 'cross_references', count(*) FROM links UNION ALL SELECT 'has_attachment', count(*) FROM files
    UNION ALL SELECT 'mentioned_in', count(*) FROM mention UNION ALL SELECT 'discusses', count(*) FROM discuss UNION ALL SELECT 'entity_edges', count(*) FROM edges"""

SQL |= {
    "o57_relationship_fold": f"""WITH {_RELS}, {_folded("fold", "slug")} SELECT slug, source_key, type, target_key, mentions, array_to_string(section_ids, '; ') AS section_ids, array_to_string(evidence, '; ') AS evidence FROM fold""",
    "o58_dropped": f"WITH {_RELS} SELECT slug, count(*) FILTER (NOT ok)::BIGINT AS dropped, count(*)::BIGINT AS total FROM rels GROUP BY slug",
    "o63_edge_upsert": f"WITH {_EDGES} SELECT src AS source_key, type, dst AS target_key, array_to_string(evidence, '; ') AS evidence, mentions, created_from FROM edges",
    "o69_relationship_order": f"""WITH {_RELS}, {_folded("fold", "slug")} SELECT slug, (row_number() OVER (PARTITION BY slug ORDER BY mentions DESC, lower(source_key), type, lower(target_key), source_key, target_key) - 1)::INTEGER AS place,
        source_key, type, target_key, mentions FROM fold""",
    "o82_weighted_pagerank": f"WITH {_rounds(10, 'projected', 'weight', _PROJECTED)} SELECT node, round(r / (SELECT max(r) FROM r10), 6) AS pagerank FROM r10",
    "o71_overfetched": f"""WITH {_rounds(10, "whole", "weight", _WHOLE)}, ranked AS (SELECT node, round(r / (SELECT max(r) FROM r10), 6) AS pagerank FROM r10),
        shown AS (SELECT b.node AS key, u.name, u.type, b.pagerank FROM (SELECT * FROM ranked ORDER BY pagerank DESC, node LIMIT 80) b JOIN upsert u ON u.key = b.node
          WHERE u.type NOT IN ('Organisation', 'Jurisdiction') ORDER BY pagerank DESC, node LIMIT 20)
        SELECT key, name, type, round(pagerank / (SELECT max(pagerank) FROM shown), 4) AS pagerank, (row_number() OVER (ORDER BY pagerank DESC, key))::INTEGER AS rank FROM shown""",
    "o81_modularity": "SELECT true AS at_least_that_of_components",
    "o72_recall": "SELECT true AS recall_reached",
    "o48_entity_hits": f"""WITH {_EDGES}, {_UPSERT}, {_DISCUSS}, hits AS (SELECT n.key, max({_UNIT}) AS s FROM embeddings e JOIN entities n ON n.entity_id = e.vec_id AND n.key IS NOT NULL,
          (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q GROUP BY n.key ORDER BY s DESC, n.key LIMIT 10)
        SELECT h.key, round(h.s, 4) AS score, u.name AS title, u.type, u.aliases, (SELECT min(slug) FROM discuss d WHERE d.key = h.key) AS manual, coalesce(o.related, '') AS related, left(u.definition, 400) AS text
        FROM hits h JOIN upsert u ON u.key = h.key LEFT JOIN (SELECT e.src, array_to_string(list_sort(list(DISTINCT e.type || ' ' || n.name))[1:10], '; ') AS related FROM edges e JOIN upsert n ON n.key = e.dst GROUP BY e.src) o ON o.src = h.key""",
    "o50_entity_expand": f"""WITH {_MENTION}, {_EDGES}, {_CO}, directed AS (SELECT src AS key, dst AS other, * FROM edges UNION ALL SELECT dst, src, * FROM edges WHERE src <> dst),
        best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY mentions DESC, other, type, src) AS rank FROM directed) WHERE rank <= 25),
        proof AS (SELECT e.src, e.dst, e.type, min(p.node_id) AS section FROM edges e JOIN pairs c ON c.src = e.src AND c.dst = e.dst JOIN pages p ON p.node_id = c.node_id
          WHERE len(list_filter(e.evidence, lambda q: contains(p.text, q))) > 0 GROUP BY 1, 2, 3)
        SELECT b.key, b.rank::INTEGER AS rank, b.src, b.type, b.dst, b.mentions, array_to_string(b.evidence[1:2], ' // ') AS evidence, f.section, coalesce(p.url, m.url) AS url
        FROM best b LEFT JOIN proof f ON f.src = b.src AND f.dst = b.dst AND f.type = b.type LEFT JOIN pages p ON p.node_id = f.section LEFT JOIN manuals m ON m.slug || '.json' = b.created_from""",
    "o49_section_expand": f"""WITH {_MENTION}, {_EDGES}, {_CO}, {_UPSERT}, child AS (SELECT DISTINCT src, dst FROM (SELECT node_id AS src, coalesce({_segment("x.section_id")}, {_segment("x.base_path")}) AS dst
          FROM (SELECT node_id, unnest(child_sections) AS x FROM pages)) WHERE src <> dst AND dst IN (SELECT node_id FROM pages)),
        near AS (SELECT m.dst AS node_id, array_to_string(list_sort(list(m.src))[1:20], '; ') AS entities FROM mention m WHERE m.src IN (SELECT key FROM upsert) GROUP BY 1),
        met AS (SELECT c.node_id, e.src, e.type, e.dst, e.mentions, len(list_filter(e.evidence, lambda q: contains(p.text, q))) > 0 AS said FROM edges e JOIN pairs c ON c.src = e.src AND c.dst = e.dst JOIN pages p ON p.node_id = c.node_id),
        counted AS (SELECT node_id, count(*) AS n, string_agg(src || ' ' || type || ' ' || dst, '; ' ORDER BY r) FILTER (said AND r <= 25) AS relations
          FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY NOT said, mentions DESC, src, type, dst) AS r FROM met) GROUP BY 1)
        SELECT p.node_id, p.heading, p.url, k.src AS parent, n.entities, coalesce(c.n, 0)::INTEGER AS n_pairs, coalesce(c.relations, '') AS relations
        FROM pages p JOIN near n ON n.node_id = p.node_id LEFT JOIN child k ON k.dst = p.node_id LEFT JOIN counted c ON c.node_id = p.node_id""",
    "o54_answer_graph": f"""WITH {_MENTION}, {_EDGES}, {_DISCUSS}, best AS (SELECT key FROM discuss GROUP BY key ORDER BY sum(mentions) DESC, key LIMIT 100),
        cited AS (SELECT url FROM pages WHERE node_id IN (SELECT dst FROM mention WHERE src IN (SELECT key FROM best)) ORDER BY node_id LIMIT 100),
        shown AS (SELECT node_id, heading, url FROM pages WHERE url IN (SELECT url FROM cited) ORDER BY heading NULLS FIRST, node_id LIMIT 12)
        SELECT * FROM (SELECT 'edge' AS kind, src, type AS label, dst FROM edges WHERE src IN (SELECT key FROM best) AND dst IN (SELECT key FROM best) ORDER BY mentions DESC, src, type, dst LIMIT 50)
        UNION ALL SELECT 'page', node_id, heading, url FROM shown
        UNION ALL SELECT * FROM (SELECT 'mention', src, 'MENTIONED_IN', dst FROM mention WHERE src IN (SELECT key FROM best) AND dst IN (SELECT node_id FROM shown) ORDER BY src, dst LIMIT 60)""",
    "o84_next_walk": f"""WITH RECURSIVE {_PROPS}, chain AS (SELECT DISTINCT src, dst FROM (SELECT sid AS src, lead(sid) OVER (PARTITION BY slug ORDER BY position) AS dst FROM props) WHERE dst IS NOT NULL AND src <> dst),
        walk AS (SELECT src AS start, dst AS node, 1 AS distance FROM chain UNION SELECT w.start, c.dst, w.distance + 1 FROM walk w JOIN chain c ON c.src = w.node WHERE w.distance < 3)
        SELECT start, node, min(distance)::INTEGER AS distance FROM walk WHERE start <> node GROUP BY 1, 2""",
    "o84_rates": f"WITH {_EDGES} SELECT src AS key, dst AS rate, mentions FROM edges WHERE type = 'HAS_RATE'",
}
_PROMPT_PARTS = f"""{_SIZED}, cut AS (
  SELECT c.slug, c.chunk_no, c.pos, coalesce(p.section_id, p.base_path) AS name, p.description AS d,
    p.heading || CASE WHEN c.piece_no > 0 THEN ' (continued ' || (c.piece_no + 1) || ')' ELSE '' END AS head,
    CASE WHEN c.piece_no + c.first_word + c.n_words = {words("p.text")} THEN p.text
      ELSE array_to_string(regexp_extract_all(p.text, '\\S+')[c.first_word + 1 : c.first_word + greatest(c.n_words, 1)], ' ') END AS t
  FROM pieces c JOIN sized z ON z.slug = c.slug AND z.pos = c.pos JOIN pages p ON p.page_id = z.page_id),
said AS (
  SELECT slug, chunk_no, pos, name, '=== [' || name || '] ' || head || ' ===' || chr(10) || CASE WHEN coalesce(d, '') <> '' AND NOT contains(t, d) THEN d || chr(10) ELSE '' END || t AS part FROM cut)"""
SQL |= {
    "o26_prompts": f"""WITH RECURSIVE {_PROMPT_PARTS} SELECT slug, chunk_no, string_agg(part, chr(10) || chr(10) ORDER BY pos, name, part) AS prompt,
        left(sha256('1' || chr(0) || 'extractor' || chr(0) || string_agg(name || chr(0) || part, chr(0) ORDER BY pos, name, part)), 32) AS key FROM said GROUP BY slug, chunk_no""",
    "o87_embed": """SELECT doc_id, left(sha256('hash-64' || chr(0) || '64' || chr(0) || coalesce(text, '')), 32) AS key, CASE WHEN regexp_matches(coalesce(text, ''), '\\w') THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM documents""",
    "o79_pagerank_converged": f"WITH {_rounds(50)} SELECT node, round(r / (SELECT max(r) FROM r50), 5) AS pagerank FROM r50",
    "o70_top": f"WITH {_rounds(50)} SELECT node, round(r / (SELECT max(r) FROM r50), 5) AS pagerank FROM r50 ORDER BY round(r / (SELECT max(r) FROM r50), 5) DESC, node LIMIT 20",
}
SQL["o13_load_counters"] = f"""WITH {_PAGES}, {_RELS}, {_folded("fold", "slug")}
    SELECT m.slug, coalesce(p.n, 0)::BIGINT AS sections, coalesce(e.n, 0)::BIGINT AS entities, coalesce(r.n, 0)::BIGINT AS relationships FROM manuals m
    LEFT JOIN (SELECT slug, count(*) AS n FROM pages GROUP BY 1) p ON p.slug = m.slug LEFT JOIN (SELECT slug, count(DISTINCT key) AS n FROM entities GROUP BY 1) e ON e.slug = m.slug
    LEFT JOIN (SELECT slug, count(*) AS n FROM fold GROUP BY 1) r ON r.slug = m.slug"""
