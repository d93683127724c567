"""Queries of the general data problems: references, hierarchies, nested records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.operators import hierarchy as H
from foliograph.operators import nested as N
from foliograph.operators import references as R
from foliograph.session import cut, read

Query = Callable[[SparkSession, str], DataFrame]


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sections, extractions = read(spark, d, "sections"), read(spark, d, "extractions")
    return R.page_references(sections, extractions), R.node_states(sections)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    refs, states = _references(spark, d)
    return R.orphan_references(refs, states).select("ref_field", "row_id", "target_id", "fault")


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    refs, states = _references(spark, d)
    return R.orphan_counts(refs, states).select("table_name", "ref_field", F.date_format("period", "yyyy-MM").alias("period"), "fault", "n_refs", "n_targets")


def _tree(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    pages = cut(H.newest_pages(read(spark, d, "sections")))
    links = cut(H.contents_links(pages))
    return H.hierarchy(pages, links), links


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d)[0].select("node_id", "root_id", "depth")


def p2_paths(spark: SparkSession, d: str) -> DataFrame:
    return H.with_paths_and_counts(*_tree(spark, d))


def p2_descendants(spark: SparkSession, d: str) -> DataFrame:
    tree, links = _tree(spark, d)
    return H.all_descendants(cut(tree), links)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    rows = N.Flattened(read(spark, d, "raw_documents")).rows
    return rows.filter(F.col("element").isin(*N.ELEMENTS.values())).select("record_id", "element", "parent_no", "item_no")


#: Columns of the flat tables that the SQL has too; the tables have every field there is.
P4_TABLES = {
    "section": ["section_id", "base_path", "title", "heading", "description", "text", "public_updated_at", "withdrawn", "error"],
    "child_section": ["section_id", "title", "base_path", "group"],
    "cross_reference": ["href", "text"],
    "attachment": ["title", "url", "content_type"],
    "entity": ["key", "name", "type", "definition", "salience", "mentions"],
    "relationship": ["source", "type", "target"],
    "evidence": ["value"],
    "manual.organisations": ["value"],
}


def _p4_table(element: str) -> Query:
    def table(spark: SparkSession, d: str) -> DataFrame:
        rows = N.flat_table(read(spark, d, "raw_documents"), element)
        have = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in P4_TABLES[element]]
        return rows.select("record_id", "node_key", "parent_key", "item_no", *have)

    return table


P4_NAMES = {"section": "p4_sections", "child_section": "p4_child_sections", "cross_reference": "p4_cross_references", "attachment": "p4_attachments", "entity": "p4_entities", "relationship": "p4_relationships", "evidence": "p4_evidence", "manual.organisations": "p4_organisations"}

QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_counts, p2_found, p2_paths, p2_descendants, p4_found)}
QUERIES.update({name: _p4_table(element) for element, name in P4_NAMES.items()})
