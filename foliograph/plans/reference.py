"""Queries of the crawl, extraction, graph and retrieval operators, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.functions import html
from foliograph.functions import ids
from foliograph.functions import text as T
from foliograph.operators import centrality, chunking, components, folds, graph_model, listing, models, nested, retrieval, traversal, vectors
from foliograph.session import cut, read
from foliograph.sources import documents as docs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _pages(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Newest rows of the pages that are there, with the columns named."""
    return graph_model.newest_sections(read(spark, d, "sections"), *columns)


#: What the place of a page in its manual and its properties are made of.
PLACE = ("page_id", "slug", "section_id", "base_path")
ELIGIBLE = ("error", "is_contents_page", "text", "description")


# --------------------------------------------------------------------------- listing and text


@query
def o01_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """The first document of each text; digests are shuffled instead of texts."""
    rows = read(spark, d, "documents").select("doc_id", "source", "n_chars", F.sha2("text", 256).alias("digest"))
    return listing.first_seen(rows, ["digest"], ["doc_id"]).drop("digest")


@query
def o02_listing(spark: SparkSession, d: str) -> DataFrame:
    return listing.listed(read(spark, d, "manuals"), organisation="Revenue Office").select("slug", "title", "format")


@query
def o05_incomplete(spark: SparkSession, d: str) -> DataFrame:
    return listing.incomplete(read(spark, d, "sections"))


@query
def o15_html_text(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "sections").filter("text is not null").select("page_id", html.text_of_html(F.col("text")).alias("text"))


@query
def o16_clean(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.clean(F.col("text")).alias("text"))


@query
def o17_links(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "sections").filter(F.contains("text", F.lit("<"))).select("page_id", F.explode(html.links_of_html(F.col("text"))).alias("l"))
    return rows.select("page_id", "l.href", F.col("l.text").alias("label"))


@query
def o18_slug(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "sections").select("page_id", T.last_path_segment(F.col("url")).alias("slug"))


@query
def o19_heading(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "sections").select("page_id", T.heading(F.col("title"), F.coalesce("section_id", F.lit(""))).alias("heading"))


@query
def o20_measures(spark: SparkSession, d: str) -> DataFrame:
    return listing.measures(read(spark, d, "sections"))


@query
def o21_children(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "sections").select("page_id", F.posexplode("child_sections").alias("pos", "c"))
    return rows.select("page_id", "pos", "c.section_id", "c.title", "c.base_path", F.nullif(F.col("c.group_title"), F.lit("")).alias("group_title"))


@query
def o22_norm(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "extractions").select("mention_id", T.norm(F.col("name")).alias("key"))


@query
def o23_eligible(spark: SparkSession, d: str) -> DataFrame:
    return chunking.eligible(read(spark, d, "sections")).select("page_id", T.word_count(F.col("text")).cast("int").alias("words"))


@query
def o24_props(spark: SparkSession, d: str) -> DataFrame:
    rows = _pages(spark, d, *PLACE, "title", "heading", "description", "is_contents_page", "withdrawn")
    return listing.section_props(rows.withColumn("text", F.lit(None).cast("string"))).drop("text", "description")


@query
def o25_embedding_text(spark: SparkSession, d: str) -> DataFrame:
    rows = _pages(spark, d, "page_id", "heading", "text", "is_contents_page").filter(~F.col("is_contents_page") & (T.word_count(F.col("text")) >= 10))
    return rows.select("page_id", models.embedding_text("heading", "text").alias("text"))


@query
def o09_content_key(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.content_key([F.lit("m"), F.lit(64), F.col("text")]).alias("key"))


@query
def o27_salvage(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "raw_documents").select("record_id", docs.salvage_json(F.col("payload")).isNotNull().alias("usable"))


@query
def o29_ids(spark: SparkSession, d: str) -> DataFrame:
    listed = retrieval.id_column(F.to_json("section_ids"))
    return read(spark, d, "extractions").select("mention_id", F.array_join(F.array_sort(listed), ",").alias("ids"))


@query
def o30_snippets(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.snippet(F.col("text")).alias("snippet"), T.ellipsis(F.col("text")).alias("label"), (F.length("text") > retrieval.MAX_TEXT).alias("truncated"))


@query
def o33_quotes_held(spark: SparkSession, d: str) -> DataFrame:
    """Mentions whose definition holds their name or an alias, with the quotes it holds."""
    quotes = F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))
    held = F.filter(quotes, lambda q: F.contains("definition", q))
    rows = read(spark, d, "extractions").select("mention_id", held.alias("held")).filter(F.size("held") > 0)
    return rows.select("mention_id", F.array_join(F.array_sort("held"), "; ").alias("held"))


@query
def o35_guarded_sql(spark: SparkSession, d: str) -> DataFrame:
    views = {"manual_view": read(spark, d, "manuals")}
    return retrieval.guarded_sql(spark, "select format, count(*) as n from manual_view where title <> 'DROP; -- SET' group by format order by format", views)


# --------------------------------------------------------------------------- chunks and caches


def _sized(spark: SparkSession, d: str) -> DataFrame:
    """Eligible newest pages with their place in the manual and words. The text is reduced to its words as soon as the
    newest row is known; only names and numbers are sorted."""
    rows = chunking.eligible(_pages(spark, d, *PLACE, *ELIGIBLE)).select(*PLACE, T.word_count(F.col("text")).alias("words"))
    return listing.positions(rows.withColumn("words", F.col("words"))).join(rows.select("page_id", "words"), "page_id").select("slug", F.col("position").alias("pos"), "page_id", "words")


@query
def o36_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.greedy_chunks(_sized(spark, d), budget=400)


@query
def o13_dry_run(spark: SparkSession, d: str) -> DataFrame:
    """What a run would do, without doing it: sections, chunks and words per manual."""
    chunks = chunking.greedy_chunks(_sized(spark, d), budget=400)
    return chunks.groupBy("slug").agg(F.countDistinct("pos").alias("sections"), F.countDistinct("chunk_no").alias("chunks"), F.sum("n_words").alias("words"))


@query
def o13_load_counters(spark: SparkSession, d: str) -> DataFrame:
    """What a load would write per manual, without writing it: sections, entities and relationships, zero where none."""
    count = lambda df, name: df.groupBy("slug").agg(F.count(F.lit(1)).alias(name))
    out = read(spark, d, "manuals").select("slug").distinct()
    out = out.join(count(_pages(spark, d, "slug"), "sections"), "slug", "left")
    out = out.join(count(read(spark, d, "entities").filter("key is not null").select("slug", "key").distinct(), "entities"), "slug", "left")
    out = out.join(count(folds.relationship_fold(_relationships(spark, d)), "relationships"), "slug", "left")
    return out.select("slug", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("sections", "entities", "relationships")))


@query
def o40_first_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The first three chunks of each manual: the cap of a trial run."""
    return chunking.first_chunks(chunking.greedy_chunks(_sized(spark, d), budget=400), 3)


@query
def o37_halves(spark: SparkSession, d: str) -> DataFrame:
    chunks = chunking.greedy_chunks(_sized(spark, d), budget=400)
    rows = chunks.withColumn("chunk", F.concat_ws("#", "slug", F.col("chunk_no").cast("string")))
    base = rows.groupBy("chunk").agg(F.min("pos").alias("first"))
    return chunking.halves(rows.join(base, "chunk").select("chunk", (F.col("pos") - F.col("first")).cast("int").alias("pos"), "n_words")).select("chunk", "pos", "first_word", "n_words", "half")


@query
def o26_prompts(spark: SparkSession, d: str) -> DataFrame:
    sized = cut(_sized(spark, d))
    chunks = chunking.greedy_chunks(sized, budget=400).join(sized.select("slug", "pos", "page_id"), ["slug", "pos"])
    pages = _pages(spark, d, "page_id", "section_id", "base_path", "heading", "description", "text")
    rows = chunks.join(pages, "page_id")
    name = F.coalesce("section_id", "base_path")
    text = F.when(F.col("piece_no") + F.col("first_word") + F.col("n_words") == T.word_count(F.col("text")), F.col("text")).otherwise(chunking.piece_text(F.col("text"), F.col("first_word"), F.col("n_words")))
    part = chunking.prompt_part(name, chunking.piece_heading(F.col("heading"), F.col("piece_no")), F.col("description"), text)
    return chunking.chunk_keys(chunking.chunk_prompts(rows.select("slug", "chunk_no", "pos", name.alias("section_id"), part.alias("part"))), "extractor")


@query
def o45_cache_hits(spark: SparkSession, d: str) -> DataFrame:
    hits, _ = chunking.cache_split(read(spark, d, "documents").select("doc_id"), _labels(spark, d), "doc_id")
    return hits


@query
def o45_cache_todo(spark: SparkSession, d: str) -> DataFrame:
    return chunking.cache_split(read(spark, d, "documents").select("doc_id"), _labels(spark, d), "doc_id")[1]


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "doc_labels").select("doc_id", F.lower("kind").alias("result"), F.struct("labelled_at", "annotator").alias("seq"))


@query
def o86_extract(spark: SparkSession, d: str) -> DataFrame:
    prompts = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("prompt"))
    return models.extract_all(prompts, models.RuleExtractor)


@query
def o87_embed(spark: SparkSession, d: str) -> DataFrame:
    rows = models.embed_all(read(spark, d, "documents").select("doc_id", "text"), lambda: models.HashEmbedder(64), 64, "hash-64")
    return rows.select("doc_id", "key", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x), 3).alias("norm"))


# --------------------------------------------------------------------------- folds


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    """Extractions with the section ids that their manual has."""
    known = read(spark, d, "sections").filter("section_id is not null").select("slug", "section_id").distinct()
    rows = read(spark, d, "extractions")
    ok = rows.select("mention_id", "slug", F.explode("section_ids").alias("section_id")).join(known, ["slug", "section_id"], "left_semi").groupBy("mention_id").agg(F.collect_set("section_id").alias("_ok"))
    coded = known.select(F.col("slug").alias("_coded")).distinct()
    out = rows.join(ok, "mention_id", "left").join(coded, rows["slug"] == coded["_coded"], "left")
    valid = F.when(F.col("_coded").isNull(), F.col("section_ids")).otherwise(F.coalesce("_ok", F.array().cast("array<string>")))
    return out.select(*[c for c in rows.columns if c != "section_ids"], valid.alias("section_ids"))


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return folds.entity_fold(_mentions(spark, d))


def _joined(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "; ") for c in columns})


@query
def o56_entity_fold(spark: SparkSession, d: str) -> DataFrame:
    return _joined(_entities(spark, d), "aliases", "section_ids")


@query
def o44_alias_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Each alias of each entity, with the key it resolves to in its document."""
    entities = cut(_entities(spark, d))
    names = entities.select("slug", F.explode("aliases").alias("alias")).distinct()
    return folds.resolve(names, "alias", entities, "resolved_key").select("slug", "alias", "resolved_key")


def _with(df: DataFrame, *columns: str) -> DataFrame:
    """df with the columns, null where no record has such a field."""
    return df.select("*", *(F.lit(None).cast("string").alias(c) for c in columns if c not in df.columns))


def _relationships(spark: SparkSession, d: str) -> DataFrame:
    """Relationships of the raw records, one row each with its evidence. Their ends are resolved within the manual: an
    entity's key, else the key that an alias stands for, of the entities loaded from it."""
    flat = nested.Flattened(read(spark, d, "raw_documents"))
    flat.rows = cut(flat.rows.filter(F.col("element").isin("relationship", "evidence") | (F.col("path") == "enrichment.relationships.section_ids")))
    rels = _with(flat.table("relationship"), "source", "type", "target")
    said = _with(flat.table("evidence"), "value").groupBy(F.col("parent_key").alias("node_key"))
    pages = _with(flat.table("enrichment.relationships.section_ids"), "value").groupBy(F.col("parent_key").alias("node_key")).agg(F.collect_set("value").alias("section_ids"))  # of one element
    said = said.agg(F.transform(F.array_sort(F.collect_list(F.struct("item_no", "value"))), lambda x: x["value"]).alias("evidence"))  # quotes of one element
    rows = rels.join(said, "node_key", "left").join(pages, "node_key", "left").join(read(spark, d, "raw_documents").select("record_id", "slug"), "record_id")
    rows = rows.select("slug", F.struct("record_id", "item_no").alias("seq"), "source", "type", "target", "evidence", "section_ids")
    known = cut(folds.name_map(folds.loaded_names(read(spark, d, "entities")), order="first"))
    for end in ("source", "target"):
        rows = rows.withColumn("name_key", T.norm(F.col(end))).join(known.withColumnRenamed("key", f"{end}_key"), ["slug", "name_key"], "left").drop("name_key")
    return rows.select("slug", "seq", "source_key", "type", "target_key", "evidence", "section_ids")


@query
def o57_relationship_fold(spark: SparkSession, d: str) -> DataFrame:
    return _joined(folds.relationship_fold(_relationships(spark, d)), "section_ids", "evidence")


@query
def o58_dropped(spark: SparkSession, d: str) -> DataFrame:
    return folds.dropped_counts(_relationships(spark, d))


@query
def o59_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return listing.count_map(read(spark, d, "extractions"), "slug", "type")


@query
def o60_totals(spark: SparkSession, d: str) -> DataFrame:
    out = listing.crawl_totals(read(spark, d, "sections"))
    return out.select(F.coalesce("slug", F.lit("(all)")).alias("slug"), "fetches", "failed", F.col("words").cast("bigint").alias("words"), F.col("chars").cast("bigint").alias("chars"), "attachments")


@query
def o61_entity_upsert(spark: SparkSession, d: str) -> DataFrame:
    return _joined(folds.entity_upsert(read(spark, d, "entities")), "aliases")


@query
def o62_discusses(spark: SparkSession, d: str) -> DataFrame:
    return folds.discusses_upsert(read(spark, d, "entities")).withColumn("salience", F.coalesce("salience", F.lit("")))


def _loads(spark: SparkSession, d: str) -> DataFrame:
    """Relationship loads: the fold of each record is one load, in the order of the records."""
    rows = _relationships(spark, d)
    by_record = folds.relationship_fold(rows.withColumn("load", F.struct("seq.record_id", "slug")), doc="load")
    return by_record.select(F.col("load.record_id").alias("seq"), "source_key", "type", "target_key", "evidence", "mentions", F.concat("load.slug", F.lit(".json")).alias("created_from"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return folds.edge_upsert(_loads(spark, d))


@query
def o63_edge_upsert(spark: SparkSession, d: str) -> DataFrame:
    return _joined(_edges(spark, d), "evidence")


@query
def o69_entity_order(spark: SparkSession, d: str) -> DataFrame:
    """Each document's list of entities in its order."""
    names = folds.entity_upsert(read(spark, d, "entities")).select("key", "name")
    rows = folds.discusses_upsert(read(spark, d, "entities")).join(names, "key")
    return folds.placed(rows, folds.entity_order(), "place").select("slug", "place", "key", "name", "mentions")


@query
def o69_relationship_order(spark: SparkSession, d: str) -> DataFrame:
    """Each document's list of relationships in its order."""
    rows = folds.relationship_fold(_relationships(spark, d))
    return folds.placed(rows, folds.relationship_order(), "place").select("slug", "place", "source_key", "type", "target_key", "mentions")


@query
def o93_back_pointers(spark: SparkSession, d: str) -> DataFrame:
    rows = folds.back_pointers(_entities(spark, d), folds.relationship_fold(_relationships(spark, d)))
    return rows.select("slug", "section_id", F.array_join("entity_mentions", "; ").alias("entity_mentions"), F.array_join(F.transform("relationship_refs", lambda x: x.cast("string")), ",").alias("relationship_refs"))


# --------------------------------------------------------------------------- graph


@query
def o39_next(spark: SparkSession, d: str) -> DataFrame:
    return listing.next_chain(listing.positions(_pages(spark, d, *PLACE)))


@query
def o41_child_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph_model.child_edges(_pages(spark, d, "child_sections"))


@query
def o42_cross_references(spark: SparkSession, d: str) -> DataFrame:
    return graph_model.cross_reference_edges(_pages(spark, d, "cross_references"))


def _met(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of entities on pages that are there."""
    return graph_model.mention_edges(read(spark, d, "entities"), graph_model.node_ids(read(spark, d, "sections")))


@query
def o46_mentioned_in(spark: SparkSession, d: str) -> DataFrame:
    return _met(spark, d)


@query
def o10_attachments(spark: SparkSession, d: str) -> DataFrame:
    return graph_model.attachment_nodes(_pages(spark, d, "attachments")).select("url", "title", "content_type")


@query
def o65_summary(spark: SparkSession, d: str) -> DataFrame:
    return graph_model.summary(graph_model.build(read(spark, d, "manuals"), read(spark, d, "sections"), read(spark, d, "entities"), _loads(spark, d)))


@query
def o94_not_unique(spark: SparkSession, d: str) -> DataFrame:
    return graph_model.not_unique(read(spark, d, "sections").select(ids.last_segment(F.col("base_path")).alias("node_id")), "node_id")


@query
def o95_format_tally(spark: SparkSession, d: str) -> DataFrame:
    return listing.tally(read(spark, d, "manuals"), "format")


def _page_edges(spark: SparkSession, d: str) -> DataFrame:
    return centrality.weights(graph_model.cross_reference_edges(_pages(spark, d, "cross_references")).withColumn("w", F.lit(1)))


@query
def o68_weights(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "entities").select(F.col("slug").alias("src"), F.col("key").alias("dst"), F.col("mentions").alias("w"))
    return centrality.weights(rows)


@query
def o79_pagerank(spark: SparkSession, d: str) -> DataFrame:
    """Ten rounds, so that the SQL can do as many."""
    ranks = centrality.pagerank(_page_edges(spark, d), max_iterations=10, tolerance=0.0)
    return ranks.select("node", F.round("pagerank", 6).alias("pagerank"))


@query
def o79_pagerank_converged(spark: SparkSession, d: str) -> DataFrame:
    """As many rounds as the operator takes: fifty, or until the ranks stand still."""
    return centrality.pagerank(_page_edges(spark, d)).withColumn("pagerank", F.round("pagerank", 5))


@query
def o70_top(spark: SparkSession, d: str) -> DataFrame:
    """The twenty pages of highest rank, the ranks converged: a top-k report."""
    return centrality.top(o79_pagerank_converged(spark, d), "pagerank", 20, "node")


def _projection(spark: SparkSession, d: str) -> DataFrame:
    return centrality.projection(_edges(spark, d), folds.entity_upsert(read(spark, d, "entities")))


@query
def o82_weighted_pagerank(spark: SparkSession, d: str) -> DataFrame:
    """Ten rounds over the projection of the entities with their weights, so that the SQL can do as many."""
    ranks = centrality.pagerank(_projection(spark, d), max_iterations=10, tolerance=0.0)
    return ranks.select("node", F.round("pagerank", 6).alias("pagerank"))


@query
def o71_overfetched(spark: SparkSession, d: str) -> DataFrame:
    """What a trial run shows of the ranks of all entities that have edges, hubs left out afterwards."""
    edges = _edges(spark, d).select(F.col("source_key").alias("src"), F.col("target_key").alias("dst"), F.col("mentions").alias("w"))
    ranks = centrality.pagerank(centrality.weights(edges), max_iterations=10, tolerance=0.0)
    ranks = ranks.withColumn("pagerank", F.round("pagerank", 6))
    out = centrality.overfetched(ranks, folds.entity_upsert(read(spark, d, "entities")), 20)
    return out.withColumn("pagerank", F.round("pagerank", 4)).withColumn("rank", F.col("rank").cast("int"))


@query
def o80_components(spark: SparkSession, d: str) -> DataFrame:
    return centrality.components(_page_edges(spark, d))


@query
def o81_communities(spark: SparkSession, d: str) -> DataFrame:
    return centrality.communities(_page_edges(spark, d))


@query
def o67_component_sizes(spark: SparkSession, d: str) -> DataFrame:
    labels = components.connected_components(_page_edges(spark, d))
    return labels.groupBy("component").agg(F.count(F.lit(1)).alias("n"))


@query
def o78_projection(spark: SparkSession, d: str) -> DataFrame:
    return _projection(spark, d)


@query
def o81_modularity(spark: SparkSession, d: str) -> DataFrame:
    """Modularity of the communities beside that of the components: a property that the communities must have."""
    edges = cut(_page_edges(spark, d))
    parts = components.connected_components(edges).withColumnRenamed("component", "community")
    good = centrality.modularity(edges, centrality.communities(edges)) >= centrality.modularity(edges, parts) - 1e-9
    return spark.createDataFrame([(bool(good),)], "at_least_that_of_components boolean")


# --------------------------------------------------------------------------- retrieval


def _query_vector(spark: SparkSession, d: str) -> list[float]:
    return list(read(spark, d, "embeddings").orderBy("vec_id").select("embedding").first()[0])


@query
def o72_nearest(spark: SparkSession, d: str) -> DataFrame:
    hits = vectors.nearest(read(spark, d, "embeddings"), _query_vector(spark, d), vectors.clamp(10))
    return hits.select("vec_id", F.round("score", 4).alias("score"))


@query
def o72_nearest_of_each(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of every vector whose id is divisible by 50, among all vectors."""
    rows = read(spark, d, "embeddings")
    out = vectors.nearest_of_each(rows, rows.filter("vec_id % 50 = 0"), 10, 64)
    return out.select("query_id", F.col("id").alias("vec_id"), F.round("score", 4).alias("score"), F.col("rank").cast("int").alias("rank"))


@query
def o72_inverted_file(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "embeddings")
    return vectors.InvertedFile().fit(rows).search(rows, rows.filter("vec_id % 50 = 0"), 10)


@query
def o72_recall(spark: SparkSession, d: str) -> DataFrame:
    """Whether the inverted file finds at least nine tenths of the true neighbours of every fiftieth vector."""
    rows = read(spark, d, "embeddings")
    asked = rows.filter("vec_id % 50 = 0")
    true = vectors.nearest_of_each(rows, asked, 10, 64).select("query_id", "id")
    found = vectors.InvertedFile().fit(rows).search(rows, asked, 10).select("query_id", "id", F.lit(1).alias("hit"))
    return true.join(found, ["query_id", "id"], "left").agg((F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0)) >= 0.9).alias("recall_reached"))


def _found_vectors(spark: SparkSession, d: str, rows: DataFrame, id_column: str, key: str) -> DataFrame:
    """The ten keys nearest to the first vector, each by its nearest row; row n stands for vector n."""
    at = read(spark, d, "embeddings").join(rows.select(F.col(id_column).alias("vec_id"), key), "vec_id").drop("vec_id")
    q = F.array(*(F.lit(float(x)) for x in _query_vector(spark, d)))
    best = at.select(key, vectors.cosine(F.col("embedding"), q).alias("score")).filter("score is not null").groupBy(key).agg(F.max("score").alias("score"))
    return best.orderBy(F.desc("score"), key).limit(10)


@query
def o47_section_hits(spark: SparkSession, d: str) -> DataFrame:
    """The ten pages nearest to the first vector; page n of the crawl stands for vector n."""
    near = _found_vectors(spark, d, _pages(spark, d, "page_id"), "page_id", "node_id").select(F.col("node_id").alias("id"), "score")
    names = folds.entity_upsert(read(spark, d, "entities")).select("key", "name")
    return retrieval.section_hits(near, _pages(spark, d, "title", "slug", "text"), _met(spark, d), names)


@query
def o48_entity_hits(spark: SparkSession, d: str) -> DataFrame:
    """The ten entities nearest to the first vector; load n of an entity stands for vector n."""
    near = _found_vectors(spark, d, read(spark, d, "entities").filter("key is not null"), "entity_id", "key")
    return retrieval.entity_hits(near, folds.entity_upsert(read(spark, d, "entities")), folds.discusses_upsert(read(spark, d, "entities")), _typed(spark, d))


@query
def o48_entity_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Each entity with the manuals it is discussed in and its loads."""
    rows = folds.discusses_upsert(read(spark, d, "entities"))
    return rows.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("slug")), ",").alias("manuals"), F.sum("mentions").alias("mentions"))


def _typed(spark: SparkSession, d: str) -> DataFrame:
    """Typed edges between entities with their evidence, in the names of the retrieval operators."""
    return _edges(spark, d).select(F.col("source_key").alias("src"), "type", F.col("target_key").alias("dst"), "mentions", "evidence", "created_from")


@query
def o50_strongest_edges(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.strongest_edges(_typed(spark, d)).select("node", "other", "type", "mentions", F.col("rank").cast("int").alias("rank"))


@query
def o50_entity_expand(spark: SparkSession, d: str) -> DataFrame:
    """Every entity that has edges with its strongest ones, their quotes, and what to cite."""
    rows = retrieval.expand_entities(None, cut(_typed(spark, d)), cut(_met(spark, d)), _pages(spark, d, "url", "text"), read(spark, d, "manuals"))
    return rows.select("key", F.col("rank").cast("int").alias("rank"), "src", "type", "dst", "mentions", F.array_join("evidence", " // ").alias("evidence"), "section", "url")


@query
def o49_evidence_sections(spark: SparkSession, d: str) -> DataFrame:
    """Edges between entities, with the first page that mentions both and holds a quote of the edge's evidence."""
    return retrieval.evidence_sections(cut(_typed(spark, d)), cut(_met(spark, d)), _pages(spark, d, "text")).select("src", "dst", "type", "node_id")


@query
def o49_section_expand(spark: SparkSession, d: str) -> DataFrame:
    """Every page that mentions an entity, once per parent, with its first entities and the relations it states."""
    met = cut(_met(spark, d))
    children = graph_model.child_edges(_pages(spark, d, "child_sections"))
    wanted = met.select(F.col("dst").alias("node_id"))
    rows = retrieval.expand_sections(wanted, _pages(spark, d, "heading", "url", "text"), children, met, folds.entity_upsert(read(spark, d, "entities")), cut(_typed(spark, d)))
    keys = F.array_join(F.transform("entities", lambda e: e["key"]), "; ")
    said = F.array_join(F.transform("relations", lambda r: F.concat_ws(" ", r["src"], r["type"], r["dst"])), "; ")
    return rows.select("node_id", "heading", "url", "parent", keys.alias("entities"), F.col("n_pairs").cast("int").alias("n_pairs"), F.coalesce(said, F.lit("")).alias("relations"))


@query
def o51_ego_network(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.ego_network(_typed(spark, d), folds.entity_upsert(read(spark, d, "entities")))


@query
def o52_read_sections(spark: SparkSession, d: str) -> DataFrame:
    """All pages that sections refer to as children, there or not."""
    wanted = read(spark, d, "sections").select(F.explode("child_sections").alias("x")).select(ids.node_id(F.col("x.section_id"), F.col("x.base_path")).alias("node_id")).filter("node_id is not null")
    return retrieval.read_sections(_pages(spark, d, "title", "text"), wanted).select("node_id", F.length("text").alias("chars"), "truncated", "found")


def _answer(spark: SparkSession, d: str) -> list[str]:
    """The hundred entities of most mentions, as an answer might name."""
    top = folds.discusses_upsert(read(spark, d, "entities")).groupBy("key").agg(F.sum("mentions").alias("m")).orderBy(F.desc("m"), "key").limit(100)
    return [r[0] for r in top.collect()]


@query
def o54_answer_subgraph(spark: SparkSession, d: str) -> DataFrame:
    """The fifty strongest edges between the hundred entities of most mentions: a top-k report."""
    return retrieval.answer_subgraph(_typed(spark, d), _answer(spark, d)).select("src", "dst", "type", "mentions")


@query
def o54_answer_graph(spark: SparkSession, d: str) -> DataFrame:
    """The graph of an answer that names the hundred entities of most mentions and cites the first hundred pages that
    mention one of them."""
    names, met, pages = _answer(spark, d), cut(_met(spark, d)), _pages(spark, d, "heading", "url")
    cited = met.filter(F.col("src").isin(*names)).select(F.col("dst").alias("node_id")).distinct().join(pages, "node_id").orderBy("node_id").limit(100).select("url")
    return retrieval.answer_graph(_typed(spark, d), met, pages, names, [r[0] for r in cited.collect()])


def _walk(edges: DataFrame, links: int) -> DataFrame:
    return traversal.walked(edges, links).select("start", "node", "distance")


@query
def o84_next_walk(spark: SparkSession, d: str) -> DataFrame:
    """The up to three pages that follow each page in its manual."""
    chain = listing.next_chain(listing.positions(_pages(spark, d, *PLACE))).select("src", "dst")
    return _walk(chain, 3)


@query
def o84_rates(spark: SparkSession, d: str) -> DataFrame:
    """Entities with the rates they have."""
    return traversal.rates(_typed(spark, d)).select("key", "rate", "mentions")
