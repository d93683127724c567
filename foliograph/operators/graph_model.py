"""Node and edge tables of the knowledge graph, made from the crawl and the loaded entities."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.functions import ids
from foliograph.operators import folds, listing
from foliograph.operators import hierarchy as H
from foliograph.operators.references import section_node


@dataclass
class Graph:
    """Tables of the graph. Edge tables are (src, dst) with node ids, entity keys, slugs and URLs as ends."""

    documents: DataFrame
    sections: DataFrame
    attachments: DataFrame
    entities: DataFrame
    has_section: DataFrame
    next: DataFrame
    has_child: DataFrame
    cross_references: DataFrame
    has_attachment: DataFrame
    mentioned_in: DataFrame
    discusses: DataFrame
    entity_edges: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


def newest_sections(sections: DataFrame, *columns: str) -> DataFrame:
    """The newest row, by crawled_at then page_id, of each page whose newest row is a successful fetch: node_id and the
    columns named (all of them if none is). Only those are read and shuffled, so name no text that isn't needed."""
    wanted = list(columns or sections.columns)
    rows = sections.select(section_node(sections).alias("node_id"), "crawled_at", "page_id", F.struct(F.col("error").isNull().alias("ok"), F.struct(*wanted).alias("row")).alias("x")).filter("node_id is not null")
    newest = rows.groupBy("node_id").agg(F.max_by("x", F.struct("crawled_at", "page_id")).alias("x"))
    return newest.filter("x.ok").select("node_id", "x.row.*")


def node_ids(sections: DataFrame) -> DataFrame:
    """Node ids of the pages that are there."""
    return newest_sections(sections, "page_id").select("node_id")


def edges_between(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct (src, dst), different from each other, of links that start at nodes, with the other end among them too."""
    return links.filter("src <> dst").join(nodes.select(F.col("node_id").alias("dst")), "dst", "left_semi").select("src", "dst").distinct()


def child_edges(nodes: DataFrame) -> DataFrame:
    links = H.contents_links(nodes)  # ends at nodes
    return links.filter("parent <> child").select(F.col("parent").alias("src"), F.col("child").alias("dst"))


def cross_reference_edges(nodes: DataFrame) -> DataFrame:
    """Edges between pages by the links in their text, resolved to node ids."""
    said = nodes.select(F.col("node_id").alias("src"), F.explode("cross_references").alias("x")).select("src", ids.href_target(F.col("x.href")).alias("dst"))
    return edges_between(said.filter("dst is not null"), nodes)


def mention_edges(entities: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct (src entity key, dst node id) of the section ids of entities that name a page that is there."""
    said = entities.filter("key is not null").select(F.col("key").alias("src"), F.explode("section_ids").alias("x")).select("src", ids.mention_target(F.col("x")).alias("dst"))
    return said.join(nodes.select(F.col("node_id").alias("dst")), "dst", "left_semi").select("src", "dst").distinct()


def attachment_edges(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("node_id").alias("src"), F.explode("attachments").alias("a")).select("src", F.col("a.url").alias("dst")).filter("dst is not null").distinct()


def attachment_nodes(nodes: DataFrame) -> DataFrame:
    """One row per URL; title and content type of the greatest pair in a tie of several."""
    rows = nodes.select(F.explode("attachments").alias("a")).filter("a.url is not null")
    return rows.groupBy(F.col("a.url").alias("url")).agg(F.max(F.struct("a.title", "a.content_type")).alias("x")).select("url", "x.title", "x.content_type", F.lit(None).cast("bigint").alias("file_size"))


def build(manuals: DataFrame, sections: DataFrame, entities: DataFrame, relationships: DataFrame | None = None) -> Graph:
    """The whole graph. relationships are folded loads (source_key, type, target_key, evidence, mentions, created_from,
    seq), if there are any. Each table reads only the columns it needs, so that the text of pages is in the sections
    alone."""
    if relationships is None:
        relationships = sections.sparkSession.createDataFrame([], "source_key string, type string, target_key string, evidence array<string>, mentions bigint, created_from string, seq bigint")
    nodes = node_ids(sections)
    placed = listing.positions(newest_sections(sections, "page_id", "slug", "section_id", "base_path"))
    return Graph(
        documents=manuals.select("slug", "title", "url", "description", "format", "organisations", "first_published_at", "public_updated_at", "schema_version"),
        sections=newest_sections(sections), attachments=attachment_nodes(newest_sections(sections, "attachments")), entities=folds.entity_upsert(entities),
        has_section=newest_sections(sections, "slug").select(F.col("slug").alias("src"), F.col("node_id").alias("dst")), next=listing.next_chain(placed).select("src", "dst"),
        has_child=child_edges(newest_sections(sections, "child_sections")), cross_references=cross_reference_edges(newest_sections(sections, "cross_references")),
        has_attachment=attachment_edges(newest_sections(sections, "attachments")), mentioned_in=mention_edges(entities, nodes),
        discusses=folds.discusses_upsert(entities), entity_edges=folds.edge_upsert(relationships),
    )


def summary(graph: Graph) -> DataFrame:
    """(table_name, n) of every table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in graph.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_unique(df: DataFrame, key: str) -> DataFrame:
    """Values of a key that more than one row has: what a uniqueness constraint would refuse."""
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
