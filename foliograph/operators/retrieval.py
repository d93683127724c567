"""Retrieval over the graph tables: neighbourhoods of hits, expansions, reads, ego networks, guarded queries."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.functions import text as T
from foliograph.operators.centrality import HUB_EDGES, HUB_TYPES

MAX_IDS, MAX_TEXT, RELS_PER_NODE, MAX_ROWS = 10, 12_000, 25, 100
#: Entities of an expanded section, quotes of a relation, and the greatest top-k.
ENTITIES_PER_SECTION, QUOTES, MAX_HITS = 20, 2, 1_000


def coerce_ids(ids: str | list[str] | None) -> list[str]:
    """Up to ten distinct ids from a list, a JSON list or a single id, in order, without blanks. Broken JSON is an error."""
    if ids is None:
        return []
    if isinstance(ids, str):
        ids = json.loads(ids) if ids.strip().startswith("[") else [ids]
    return list(dict.fromkeys(s for x in ids if x is not None and (s := str(x).strip())))[:MAX_IDS]


def id_column(ids: Column) -> Column:
    """coerce_ids for a column of JSON lists or single ids."""
    listed = F.coalesce(F.from_json(F.when(ids.rlike(r"^\s*\["), ids), "array<string>"), F.array(ids))
    return F.slice(F.array_distinct(F.filter(F.transform(listed, T.strip), lambda x: x.isNotNull() & (x != ""))), 1, MAX_IDS)


def section_hits(hits: DataFrame, sections: DataFrame, mentions: DataFrame, names: DataFrame, snippet: int = 400) -> DataFrame:
    """Hits (id, score) on sections with title, manual, the names of up to ten entities and a snippet.

    Hits are a top-k, so they are the small side of every join, and more than MAX_HITS of them are an error; a hit
    without section or entities stays.
    """
    hits = few(hits)
    hit = F.broadcast(hits)
    named = mentions.join(F.broadcast(hits.select(F.col("id").alias("dst"))), "dst").join(names.select(F.col("key").alias("src"), "name"), "src")
    named = named.groupBy(F.col("dst").alias("id")).agg(F.array_join(F.slice(F.array_sort(F.collect_set("name")), 1, 10), "; ").alias("entities"))
    about = sections.join(F.broadcast(hits.select(F.col("id").alias("node_id"))), "node_id").select(F.col("node_id").alias("id"), "title", F.col("slug").alias("manual"), T.snippet(F.coalesce("text", F.lit("")), snippet).alias("text"))
    return hit.join(about, "id", "left").join(named, "id", "left").select("id", F.round("score", 4).alias("score"), "title", "manual", F.coalesce("entities", F.lit("")).alias("entities"), "text")


def few(rows: DataFrame, most: int = MAX_HITS) -> DataFrame:
    """rows as local data, or an error if there are more than `most`: what may be broadcast."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} rows where a top-k is meant")
    return rows.sparkSession.createDataFrame(got, rows.schema)


def entity_hits(hits: DataFrame, entities: DataFrame, discusses: DataFrame, edges: DataFrame, snippet: int = 400) -> DataFrame:
    """Hits (key, score) on entities with title, type, aliases, the first manual that discusses them, up to ten outgoing
    relations as `TYPE name`, and the beginning of the definition. More than MAX_HITS are an error; a hit that isn't an
    entity is left out."""
    hits = few(hits)
    asked = F.broadcast(hits.select("key"))
    manual = discusses.join(asked, "key", "left_semi").groupBy("key").agg(F.min("slug").alias("manual"))
    out = edges.join(F.broadcast(hits.select(F.col("key").alias("src"))), "src", "left_semi").join(entities.select(F.col("key").alias("dst"), "name"), "dst")
    out = out.groupBy(F.col("src").alias("key")).agg(F.array_join(F.slice(F.array_sort(F.collect_set(F.concat_ws(" ", "type", "name"))), 1, 10), "; ").alias("related"))
    about = entities.join(asked, "key", "left_semi").select("key", F.col("name").alias("title"), "type", F.array_join("aliases", "; ").alias("aliases"), F.coalesce(T.snippet(F.col("definition"), snippet), F.lit("")).alias("text"))
    rows = F.broadcast(hits).join(about, "key").join(manual, "key", "left").join(out, "key", "left")
    return rows.select("key", F.round("score", 4).alias("score"), "title", "type", "aliases", "manual", F.coalesce("related", F.lit("")).alias("related"), "text")


def read_sections(sections: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the wanted node ids, cut at the limit with a flag; ids that aren't there come with found false."""
    rows = wanted.select("node_id").distinct().join(sections.select("node_id", "title", "text", F.lit(True).alias("_there")), "node_id", "left")
    text = F.coalesce("text", F.lit(""))
    return rows.select("node_id", "title", F.left(text, F.lit(MAX_TEXT)).alias("text"), (F.length(text) > MAX_TEXT).alias("truncated"), F.coalesce("_there", F.lit(False)).alias("found"))


def undirected(edges: DataFrame) -> DataFrame:
    """(node, other, type, mentions) of each edge in both directions; a self loop once."""
    a = edges.select(F.col("src").alias("node"), F.col("dst").alias("other"), "type", "mentions")
    return a.unionByName(edges.filter("src <> dst").select(F.col("dst").alias("node"), F.col("src").alias("other"), "type", "mentions"))


def strongest_edges(edges: DataFrame, per_node: int = RELS_PER_NODE) -> DataFrame:
    """The edges of each node with most mentions, at most per_node, ties by the other end and type."""
    rank = F.row_number().over(W.partitionBy("node").orderBy(F.desc_nulls_last("mentions"), "other", "type"))
    return undirected(edges).withColumn("rank", rank).filter(F.col("rank") <= per_node)


def co_mentions(edges: DataFrame, mentions: DataFrame) -> DataFrame:
    """(src, dst, node_id): pages that mention both ends of an edge. Mentions meet the distinct pairs on the source, and
    what that gives meets them again on target and page at once; no evidence or text is carried along."""
    pairs = edges.select("src", "dst").distinct()
    ends = pairs.select(F.col("src").alias("e")).union(pairs.select("dst")).distinct()
    known = mentions.select(F.col("src").alias("e"), F.col("dst").alias("node_id")).join(ends, "e", "left_semi")
    return pairs.join(known.withColumnRenamed("e", "src"), "src").join(known.withColumnRenamed("e", "dst"), ["dst", "node_id"], "left_semi").select("src", "dst", "node_id")


def evidence_sections(edges: DataFrame, mentions: DataFrame, sections: DataFrame) -> DataFrame:
    """(src, dst, type, node_id, quote): the first page, by id, that mentions both ends and holds a quote of the
    edge's evidence. The equal keys of the mentions restrict the pairs before any text is searched."""
    on = edges.select("src", "dst", "type", "evidence").join(co_mentions(edges, mentions), ["src", "dst"])
    held = on.join(sections.select("node_id", "text"), "node_id").select("src", "dst", "type", "node_id", _held().alias("held")).filter(F.size("held") > 0)
    return held.groupBy("src", "dst", "type").agg(F.min(F.struct("node_id", F.array_min("held").alias("quote"))).alias("x")).select("src", "dst", "type", "x.node_id", "x.quote")


def _held() -> Column:
    """Quotes of the column `evidence` that the column `text` holds."""
    return F.coalesce(F.filter("evidence", lambda q: F.coalesce(F.contains("text", q), F.lit(False))), F.array().cast("array<string>"))


def expand_sections(wanted: DataFrame, sections: DataFrame, children: DataFrame, mentions: DataFrame, entities: DataFrame, edges: DataFrame, per: int = RELS_PER_NODE) -> DataFrame:
    """Each wanted page (node_id) that is there, once per parent: heading, url, parent, entities, n_pairs, relations.

    entities are the page's first twenty by key, as (key, name, type). relations are those between two entities of the
    page whose evidence stands in its text, at most `per` by mentions, as (src, type, dst, quotes), with two quotes at
    most. n_pairs counts those between entities of the page whatever their evidence.
    """
    pages = sections.join(wanted.select("node_id").distinct(), "node_id", "left_semi").select("node_id", "heading", "url", "text")
    ids = pages.select("node_id")
    near = mentions.select(F.col("src").alias("key"), F.col("dst").alias("node_id")).join(ids, "node_id", "left_semi")
    named = near.join(entities.select("key", "name", "type"), "key")
    rank = F.row_number().over(W.partitionBy("node_id").orderBy("key"))
    named = named.withColumn("_r", rank).filter(F.col("_r") <= ENTITIES_PER_SECTION).groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct("key", "name", "type"))).alias("entities"))
    met = near.select(F.col("key").alias("src"), F.col("node_id").alias("dst"))
    on = edges.select("src", "type", "dst", "mentions", "evidence").join(co_mentions(edges, met), ["src", "dst"])
    on = on.join(pages.select("node_id", "text"), "node_id").select("node_id", "src", "type", "dst", "mentions", _held().alias("held"))
    place = F.row_number().over(W.partitionBy("node_id").orderBy((F.size("held") == 0).cast("int"), F.desc_nulls_last("mentions"), "src", "type", "dst"))
    relation = F.struct("_r", "src", "type", "dst", F.slice("held", 1, QUOTES).alias("quotes"))
    on = on.withColumn("_r", place).groupBy("node_id").agg(F.count(F.lit(1)).alias("n_pairs"), F.array_sort(F.collect_list(F.when((F.col("_r") <= per) & (F.size("held") > 0), relation))).alias("r"))
    on = on.select("node_id", "n_pairs", F.transform("r", lambda r: F.struct(r["src"].alias("src"), r["type"].alias("type"), r["dst"].alias("dst"), r["quotes"].alias("quotes"))).alias("relations"))
    parent = children.select(F.col("dst").alias("node_id"), F.col("src").alias("parent"))
    out = pages.drop("text").join(parent, "node_id", "left").join(named, "node_id", "left").join(on, "node_id", "left")
    return out.select("node_id", "heading", "url", "parent", "entities", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), "relations")


def expand_entities(wanted: DataFrame | None, edges: DataFrame, mentions: DataFrame, sections: DataFrame, documents: DataFrame, per: int = RELS_PER_NODE) -> DataFrame:
    """(key, rank, src, type, dst, other, mentions, evidence, section, url) of the wanted keys, or of all: the `per`
    edges of most mentions of each, with two quotes. section is the first page that mentions both ends and holds a
    quote; url that of the page, else of the manual the edge was loaded from."""
    both = edges.select(F.col("src").alias("key"), F.col("dst").alias("other"), "src", "type", "dst", "mentions", "evidence", "created_from")
    both = both.unionByName(edges.filter("src <> dst").select(F.col("dst").alias("key"), F.col("src").alias("other"), "src", "type", "dst", "mentions", "evidence", "created_from"))
    if wanted is not None:
        both = both.join(wanted.select("key").distinct(), "key", "left_semi")
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc_nulls_last("mentions"), "other", "type", "src"))
    best = both.withColumn("rank", rank).filter(F.col("rank") <= per)
    proof = evidence_sections(best.select("src", "dst", "type", "evidence").distinct(), mentions, sections).select("src", "dst", "type", F.col("node_id").alias("section"))
    page = sections.select(F.col("node_id").alias("section"), F.col("url").alias("page_url"))
    manual = documents.select(F.col("slug").alias("_slug"), F.col("url").alias("manual_url"))
    out = best.join(proof, ["src", "dst", "type"], "left").join(page, "section", "left").join(manual, F.regexp_replace("created_from", r"\.json$", "") == F.col("_slug"), "left")
    return out.select("key", "rank", "src", "type", "dst", "other", "mentions", F.slice("evidence", 1, QUOTES).alias("evidence"), "section", F.coalesce("page_url", "manual_url").alias("url"))


def ego_network(edges: DataFrame, entities: DataFrame, key: str | None = None) -> DataFrame:
    """(node, other, relations, mentions, types): neighbours that aren't hubs, by edges that say something."""
    near = undirected(edges.filter(~F.col("type").isin(*HUB_EDGES)))
    if key is not None:
        near = near.filter(F.col("node") == key)
    plain = entities.filter(~F.col("type").isin(*HUB_TYPES)).select(F.col("key").alias("other"))
    return near.join(plain, "other", "left_semi").groupBy("node", "other").agg(F.count(F.lit(1)).alias("relations"), F.sum(F.coalesce("mentions", F.lit(0))).alias("mentions"), F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))


def answer_subgraph(edges: DataFrame, names: list[str], limit: int = 50) -> DataFrame:
    """Edges with both ends among the names of an answer, most mentions first."""
    inside = F.col("src").isin(*names) & F.col("dst").isin(*names)
    return edges.filter(inside).orderBy(F.desc_nulls_last("mentions"), "src", "type", "dst").limit(limit)


def answer_graph(edges: DataFrame, mentions: DataFrame, sections: DataFrame, names: list[str], urls: list[str], sections_limit: int = 12, mentions_limit: int = 60) -> DataFrame:
    """(kind, src, label, dst) of the graph of an answer that names entities and cites pages: its edges (answer_subgraph),
    the first twelve pages cited by heading (`page`, with the URL as dst), and up to sixty mentions of the entities on
    them. Without names there are no edges and mentions, without URLs no pages."""
    said = answer_subgraph(edges, names).select(F.lit("edge").alias("kind"), "src", F.col("type").alias("label"), "dst")
    cited = sections.filter(F.col("url").isin(*urls)).orderBy("heading", "node_id").limit(sections_limit).select("node_id", "heading", "url")
    pages = cited.select(F.lit("page").alias("kind"), F.col("node_id").alias("src"), F.col("heading").alias("label"), F.col("url").alias("dst"))
    met = mentions.filter(F.col("src").isin(*names)).join(F.broadcast(cited.select(F.col("node_id").alias("dst"))), "dst", "left_semi")  # twelve pages
    met = met.orderBy("src", "dst").limit(mentions_limit).select(F.lit("mention").alias("kind"), "src", F.lit("MENTIONED_IN").alias("label"), "dst")
    return said.unionByName(pages).unionByName(met)


class NotAllowed(ValueError):
    """A statement that isn't a plain query."""


_READS = {"Project", "Filter", "Join", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "SubqueryAlias", "Distinct", "Union", "Window", "WithCTE", "CTERelationDef", "CTERelationRef", "LogicalRDD", "LocalRelation", "OneRowRelation", "Range", "View", "Generate", "Expand", "Except", "Intersect", "Deduplicate", "Relation", "LogicalRelation", "Offset", "Pivot", "Tail", "LateralJoin", "DomainJoin", "UnresolvedWith", "RelationV2", "DataSourceV2Relation", "InMemoryRelation", "Sample", "TypedFilter", "UnionLoop", "UnionLoopRef", "Repartition", "RebalancePartitions", "ResolvedHint"}


def guarded_sql(spark: SparkSession, query: str, views: dict[str, DataFrame], limit: int = MAX_ROWS) -> DataFrame:
    """Result of a read-only query over the views, at most `limit` rows, limited in the plan.

    The analysed plan is inspected, not the text: any node that isn't one of reading is refused, so words in strings
    and comments do no harm. Nothing runs before the check, commands included.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    analysed = spark._jsparkSession.sessionState().analyzer().execute(plan)
    stack = [analysed]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name.split(" ")[0] not in _READS or "Command" in node.getClass().getName():
            raise NotAllowed(f"only queries are allowed, not {name}")
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return spark.sql(query).limit(limit)
