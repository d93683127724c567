"""SQL counterparts, for DuckDB, of the general data problems' queries."""

from __future__ import annotations

from foliograph.plans import nested_sql as N

_SEGMENT = "nullif(lower(split_part(regexp_replace(regexp_replace(trim({x}), '[?#].*$', ''), '/+$', ''), '/', -1)), '')"


def _segment(x: str) -> str:
    return _SEGMENT.format(x=x)


_REFS = rf"""
nodes AS (
  SELECT {_segment("base_path")} AS node_id, max_by(error IS NOT NULL, struct_pack(a := crawled_at, b := page_id)) AS gone,
         min(CASE WHEN error IS NULL THEN crawled_at END) AS first_ok
  FROM sections GROUP BY 1 HAVING {_segment("base_path")} IS NOT NULL),
raw AS (
  SELECT 'sections' AS table_name, 'child_sections' AS ref_field, page_id AS row_id, crawled_at AS at_ts,
         coalesce({_segment("x.section_id")}, {_segment("x.base_path")}) AS target_id
  FROM (SELECT page_id, crawled_at, unnest(child_sections) AS x FROM sections)
  UNION ALL
  SELECT 'sections', 'cross_references', page_id, crawled_at,
         CASE WHEN regexp_matches(regexp_replace(regexp_replace(trim(x.href), '[?#].*$', ''), '/+$', ''),
                '^([A-Za-z]+[0-9]+[A-Za-z]?|((https?:)?//www[.]manuals[.]example)?/(internal-manuals|guidance)/[^/]+/(.+/)?[^/]+)$', 'i')
              THEN {_segment("x.href")} END
  FROM (SELECT page_id, crawled_at, unnest(cross_references) AS x FROM sections)
  UNION ALL
  SELECT 'extractions', 'section_ids', mention_id, extracted_at, {_segment("trim(x, ' []' || chr(160))")}
  FROM (SELECT mention_id, extracted_at, unnest(section_ids) AS x FROM extractions)),
faulty AS (
  SELECT r.*, CASE WHEN n.node_id IS NULL THEN 'missing' WHEN n.gone THEN 'gone' WHEN n.first_ok > r.at_ts THEN 'late' END AS fault
  FROM raw r LEFT JOIN nodes n ON r.target_id = n.node_id WHERE r.target_id IS NOT NULL)
"""

SQL: dict[str, str] = {
    "p1_found": f"WITH {_REFS} SELECT DISTINCT ref_field, row_id, target_id, fault FROM faulty WHERE fault IS NOT NULL",
    "p1_counts": f"""WITH {_REFS} SELECT table_name, ref_field, strftime(at_ts, '%Y-%m') AS period, fault, count(*)::BIGINT AS n_refs,
        count(DISTINCT target_id)::BIGINT AS n_targets FROM faulty WHERE fault IS NOT NULL GROUP BY ALL""",
}

_TREE = f"""
newest AS (
  SELECT {_segment("base_path")} AS node_id, max_by(struct_pack(ok := error IS NULL, kids := child_sections), struct_pack(a := crawled_at, b := page_id)) AS x
  FROM sections GROUP BY 1),
pages AS (SELECT node_id, x.kids AS kids FROM newest WHERE x.ok AND node_id IS NOT NULL),
links AS (
  SELECT DISTINCT coalesce({_segment("k.section_id")}, {_segment("k.base_path")}) AS child, parent
  FROM (SELECT node_id AS parent, unnest(kids) AS k FROM pages)),
edges AS (SELECT child, parent FROM links WHERE child IN (SELECT node_id FROM pages)),
roots AS (SELECT node_id FROM pages WHERE node_id NOT IN (SELECT child FROM edges)),
up(node, anc) AS (SELECT child, parent FROM edges UNION SELECT u.node, e.parent FROM up u JOIN edges e ON u.anc = e.child),
onloop AS (SELECT node FROM up WHERE node = anc),
loopid AS (SELECT a.node, min(a.anc) AS root_id FROM up a JOIN up b ON a.anc = b.node AND a.node = b.anc GROUP BY a.node),
below AS (
  SELECT node, min(root_id) AS root_id FROM (
    SELECT node, root_id FROM loopid UNION ALL SELECT u.node, l.root_id FROM up u JOIN loopid l ON u.anc = l.node WHERE u.node NOT IN (SELECT node FROM onloop))
  GROUP BY node),
walk(node_id, root_id, depth, path) AS (
  SELECT node_id, node_id, 0, node_id FROM roots
  UNION ALL
  SELECT e.child, w.root_id, w.depth + 1, w.path || '/' || e.child FROM walk w JOIN edges e ON e.parent = w.node_id
  WHERE e.child NOT IN (SELECT node FROM below))
"""
SQL["p2_found"] = f"""WITH RECURSIVE {_TREE} SELECT node_id, root_id, depth::INTEGER AS depth FROM walk
    UNION ALL SELECT node, root_id, -1 FROM below"""
_BELOW_LOOPS = """
reach(node, anc, d) AS (
  SELECT child, parent, 1 FROM edges WHERE child IN (SELECT node FROM below) AND child <> parent
  UNION SELECT r.node, e.parent, r.d + 1 FROM reach r JOIN edges e ON e.child = r.anc WHERE e.child <> e.parent AND r.d <= (SELECT count(*) FROM below)),
descent AS (
  SELECT u.anc, u.node, (a.depth - b.depth)::INTEGER AS d FROM up u JOIN walk a ON a.node_id = u.node JOIN walk b ON b.node_id = u.anc
  UNION ALL SELECT anc, node, min(d)::INTEGER FROM reach WHERE node <> anc GROUP BY ALL),
hang AS (SELECT child, min(parent) AS parent FROM edges WHERE child IN (SELECT node FROM below) AND child NOT IN (SELECT node FROM onloop) AND parent IN (SELECT node FROM below) GROUP BY child),
hung(node_id, path) AS (SELECT DISTINCT node, node FROM onloop UNION ALL SELECT h.child, w.path || '/' || h.child FROM hung w JOIN hang h ON h.parent = w.node_id)
"""
SQL["p2_paths"] = f"""WITH RECURSIVE {_TREE}, {_BELOW_LOOPS}, kids AS (SELECT anc, count(*) AS n FROM descent GROUP BY anc)
    SELECT node_id, root_id, depth::INTEGER AS depth, path, false AS on_loop, coalesce(n, 0)::BIGINT AS n_descendants FROM walk LEFT JOIN kids ON anc = node_id
    UNION ALL SELECT b.node, b.root_id, -1, h.path, b.node IN (SELECT node FROM onloop), coalesce(n, 0)::BIGINT FROM below b JOIN hung h ON h.node_id = b.node LEFT JOIN kids ON anc = b.node"""
SQL["p2_descendants"] = f"""WITH RECURSIVE {_TREE}, {_BELOW_LOOPS} SELECT anc AS node_id, node AS descendant_id, d AS distance FROM descent"""
SQL["p4_found"] = N.FOUND
SQL["p4_sections"] = N.table("section", "sec", [("section_id", "sectionId"), ("base_path", "basePath"), ("title",), ("heading",), ("description",), ("text",), ("public_updated_at", "publicUpdatedAt"), ("withdrawn",), ("error",)])
SQL["p4_child_sections"] = N.table("child_section", "kid", [("section_id", "sectionId"), ("title",), ("base_path", "basePath"), ("group",)], "section")
SQL["p4_cross_references"] = N.table("cross_reference", "ref", [("href",), ("text",)], "section")
SQL["p4_attachments"] = N.table("attachment", "att", [("title",), ("url",), ("content_type", "contentType")], "section")
SQL["p4_entities"] = N.table("entity", "ents", [("key",), ("name",), ("type",), ("definition",), ("salience",), ("mentions",)])
SQL["p4_relationships"] = N.table("relationship", "rel", [("source",), ("type",), ("target",)])
SQL["p4_evidence"] = N.values("evidence", "evi", "relationship")
SQL["p4_organisations"] = N.organisations()
