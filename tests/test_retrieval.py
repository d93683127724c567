"""Expansions, hits, search, answer graphs, and models behind them."""

from __future__ import annotations

import json

import pytest
from foliograph.operators import agent, centrality, folds, models, retrieval, search
from pyspark.sql import functions as F


@pytest.fixture
def tables(spark):
    f = spark.createDataFrame
    edges = [("a", "REQUIRES", "b", 3, ["quote one", "other", "third"], "m.json"), ("b", "HAS_RATE", "c", None, None, "m.json"), ("c", "PART_OF", "a", 5, ["nowhere"], "x.json"), ("a", "PART_OF", "a", 1, [], "m.json")]
    return {
        "edges": f(edges, "src string, type string, dst string, mentions int, evidence array<string>, created_from string"),
        "mentions": f([("a", "p1"), ("b", "p1"), ("a", "p2"), ("b", "p2"), ("c", "p2"), ("z", "p2")], "src string, dst string"),
        "sections": f([("p1", "One", "u1", "text with quote one in it, other too", "One", "m"), ("p2", "Two", "u2", "quote one", "Two", "m"), ("p3", "Three", "u3", None, None, "m")], "node_id string, heading string, url string, text string, title string, slug string"),
        "children": f([("p0", "p1"), ("p9", "p1")], "src string, dst string"),
        "entities": f([(k, k.upper(), t, k * 500, [k + "1"]) for k, t in (("a", "Tax"), ("b", "Rate"), ("c", None))], "key string, name string, type string, definition string, aliases array<string>"),
        "documents": f([("m", "manual-url")], "slug string, url string"), "discusses": f([("m", "a"), ("l", "a"), ("m", "b")], "slug string, key string"),
    }


def test_expand_sections(spark, tables):
    wanted = spark.createDataFrame([("p1",), ("p2",), ("p3",), ("p8",), ("p1",)], "node_id string")
    t = tables
    rows = retrieval.expand_sections(wanted, t["sections"], t["children"], t["mentions"], t["entities"], t["edges"]).collect()
    assert sorted((r.node_id, r.parent) for r in rows) == [("p1", "p0"), ("p1", "p9"), ("p2", None), ("p3", None)]
    by = {r.node_id: r for r in rows}
    assert [tuple(e) for e in by["p1"].entities] == [("a", "A", "Tax"), ("b", "B", "Rate")] and by["p3"].entities is None
    assert [(r.src, r.type, r.dst, r.quotes) for r in by["p1"].relations] == [("a", "REQUIRES", "b", ["quote one", "other"])]
    assert (by["p1"].n_pairs, by["p2"].n_pairs, by["p3"].n_pairs) == (2, 4, 0)
    assert [(r.src, r.dst, r.quotes) for r in by["p2"].relations] == [("a", "b", ["quote one"])]


def test_expand_entities(spark, tables):
    t = tables
    rows = retrieval.expand_entities(spark.createDataFrame([("a",), ("nobody",)], "key string"), t["edges"], t["mentions"], t["sections"], t["documents"], per=2).collect()
    got = [(r.rank, r.other, r.src, r.type, r.evidence, r.section, r.url) for r in sorted(rows, key=lambda r: r["rank"])]
    assert got == [(1, "c", "c", "PART_OF", ["nowhere"], None, None), (2, "b", "a", "REQUIRES", ["quote one", "other"], "p1", "u1")]
    rows = retrieval.expand_entities(None, t["edges"], t["mentions"], t["sections"], t["documents"]).collect()
    assert {(r.key, r.url) for r in rows if r.type == "HAS_RATE"} == {("b", "manual-url"), ("c", "manual-url")}


def test_entity_hits_and_bounds(spark, tables):
    hits = spark.createDataFrame([("a", 0.91234), ("c", 0.5), ("gone", 0.4)], "key string, score double")
    rows = {r.key: r for r in retrieval.entity_hits(hits, tables["entities"], tables["discusses"], tables["edges"]).collect()}
    assert set(rows) == {"a", "c"} and (rows["a"].score, rows["a"].title, rows["a"].manual, rows["a"].related, len(rows["a"].text)) == (0.9123, "A", "l", "PART_OF A; REQUIRES B", 400)
    assert (rows["c"].manual, rows["c"].related, rows["c"].aliases) == (None, "PART_OF A", "c1")
    with pytest.raises(ValueError, match="top-k"):
        retrieval.few(spark.range(5), 4)


def test_answer_graph(spark, tables):
    rows = retrieval.answer_graph(tables["edges"], tables["mentions"], tables["sections"], ["a", "b"], ["u1", "u3", "u7"]).collect()
    assert {(r.kind, r.src, r.label, r.dst) for r in rows} == {("edge", "a", "REQUIRES", "b"), ("edge", "a", "PART_OF", "a"), ("page", "p1", "One", "u1"), ("page", "p3", "Three", "u3"), ("mention", "a", "MENTIONED_IN", "p1"), ("mention", "b", "MENTIONED_IN", "p1")}
    assert retrieval.answer_graph(tables["edges"], tables["mentions"], tables["sections"], [], []).count() == 0


def test_search(spark, tables):
    embedder = models.HashEmbedder(16)
    embed = lambda pairs, key: spark.createDataFrame([(k, v) for (k, _), v in zip(pairs, embedder.embed([t for _, t in pairs]), strict=True)], f"{key} string, embedding array<float>")
    t = {**tables, "section_vectors": embed([("p1", "capital gains"), ("p2", "value added tax")], "node_id"), "entity_vectors": embed([("a", "gains"), ("b", "tax rate")], "key")}
    out = search.search_both("both", "capital gains", t, embedder, top=1)
    assert [r.id for r in out["sections"].collect()] == ["p1"] and [r.key for r in out["entities"].collect()] == ["a"]
    with pytest.raises(ValueError, match="kind"):
        search.search("pages", "x", t, embedder)
    tools = agent.tools(spark, t, embedder=embedder)
    assert set(tools) == {d["name"] for d in agent.DESCRIPTORS}
    told = []
    script = iter([agent.Reply(calls=[("expand", {"section_ids": "p2", "entity_keys": '["a"]'}), ("semantic_search", {"query": "tax"})]), agent.Reply(text="done")])
    out = agent.answer("q", lambda m: next(script), tools, told.append)
    assert set(json.loads(out["messages"][1]["content"])) == {"sections", "entities"} and [e["event"] for e in told] == ["call", "tool", "call", "tool"]


def test_embedding_of_a_query():
    class Flaky:
        dims, calls = 2, 0

        def embed(self, texts):
            self.calls += 1
            if self.calls < 3:
                raise models.ProviderError(503)
            return [[1.0, 2.0]]

    waits = []
    assert models.embed_query("q", Flaky(), sleep=waits.append) == [1.0, 2.0] and waits == [1.0, 2.0]
    with pytest.raises(models.FatalError):
        models.embed_query("q", Flaky(), attempts=2, sleep=waits.append)
    with pytest.raises(models.FatalError):
        models.embed_query("  ", Flaky())
    with pytest.raises(models.FatalError, match="401"):
        models.attempted(lambda: (_ for _ in ()).throw(models.ProviderError(401)), 5, waits.append)


def test_extraction_retries_and_plain_requests(spark):
    class Picky:
        calls = 0

        def extract(self, prompt):
            self.calls += 1
            if prompt == "schema":
                raise models.ProviderError(400)
            if prompt == "busy" and self.calls % 2:
                raise models.ProviderError(429)
            if prompt == "banned":
                raise models.ProviderError(403)
            return prompt

        def extract_plain(self, prompt):
            return "plain " + prompt

    rows = spark.createDataFrame([("1", "busy"), ("2", "schema"), ("3", "banned"), ("4", "ok")], "key string, prompt string").coalesce(1)
    got = {r.key: (r.result, r.error) for r in models.extract_all(rows, Picky, sleep=lambda s: None).collect()}
    assert got == {"1": ("busy", None), "2": ("plain schema", None), "3": (None, "ProviderError: status 403"), "4": ("ok", None)}


def test_overfetch(spark):
    ranks = spark.createDataFrame([(f"n{i}", 1.0 - i / 100) for i in range(20)], "node string, pagerank double")
    kinds = spark.createDataFrame([(f"n{i}", f"N{i}", "Organisation" if i < 6 else None if i == 6 else "Tax") for i in range(20)], "key string, name string, type string")
    rows = centrality.overfetched(ranks, kinds, 2).collect()
    assert [(r.key, r["rank"], round(r.pagerank, 4)) for r in rows] == [("n7", 1, 1.0)]  # eight fetched, seven of them left out


def test_ends_resolve_by_key_before_alias(spark):
    loads = spark.createDataFrame([(1, "m", "vat", ["value added tax", "x"], 1), (2, "m", "x", [], 2), (3, "m", "duty", ["x", "value added tax", "levy"], 3), (4, "l", "levy", None, 4)], "entity_id int, slug string, key string, aliases array<string>, loaded_at int")
    names = spark.createDataFrame([("m", "The Value Added Tax"), ("m", "X"), ("m", "Levy"), ("m", "none"), ("l", "vat"), ("l", None)], "slug string, name string")
    got = {(r.slug, r.name): r.k for r in folds.resolve(names, "name", folds.loaded_names(loads), "k", order="first").collect()}
    assert got == {("m", "The Value Added Tax"): "vat", ("m", "X"): "x", ("m", "Levy"): "duty", ("m", "none"): None, ("l", "vat"): None, ("l", None): None}


def test_mentions_count_relationships_not_quotes(spark):
    rows = spark.createDataFrame([("m", 1, "a", "REQUIRES", "b", ["q", "r", "q", " "], ["S"]), ("m", 2, "a", "REQUIRES", "b", None, None), ("m", 3, "a", "REQUIRES", "b", ["p", "r"], ["R"])], "slug string, seq int, source_key string, type string, target_key string, evidence array<string>, section_ids array<string>")
    (r,) = folds.relationship_fold(rows).collect()
    assert (r.mentions, r.evidence, r.section_ids) == (3, ["q", "r", "p"], ["R", "S"]) and folds.dropped_counts(rows).first().total == 3


def test_loads_of_edges_merge(spark):
    rows = spark.createDataFrame([("a", "REQUIRES", "b", ["q"], 5, "m.json", 1), ("a", "REQUIRES", "b", ["p", "q"], 2, "l.json", 2)], "source_key string, type string, target_key string, evidence array<string>, mentions int, created_from string, seq int")
    (r,) = folds.edge_upsert(rows).collect()
    assert (r.evidence, r.mentions, r.created_from) == (["p", "q"], 2, "m.json")


def test_pointers_are_attached_anew(spark):
    ents = spark.createDataFrame([("m", "k", ["S1", "S2"]), ("m", "j", ["S1"])], "slug string, key string, section_ids array<string>")
    rels = spark.createDataFrame([("m", "a", "PART_OF", "b", 1, ["S1", "S3"]), ("m", "B", "PART_OF", "a", 4, ["S1"])], "slug string, source_key string, type string, target_key string, mentions int, section_ids array<string>")
    points = folds.back_pointers(ents, rels)
    assert {r.section_id: (r.entity_mentions, r.relationship_refs) for r in points.collect()} == {"S1": (["j", "k"], [0, 1]), "S2": (["k"], []), "S3": ([], [1])}
    pages = spark.createDataFrame([(1, "m", "S1", ["old"]), (2, "m", "S1", ["old"]), (3, "m", None, ["old"]), (4, "m", "S9", ["old"])], "page_id int, slug string, section_id string, entity_mentions array<string>")
    assert {r.page_id: r.entity_mentions for r in folds.attach_to_sections(pages, points).collect()} == {1: None, 2: ["j", "k"], 3: None, 4: None}


def test_ranks_need_no_text(spark):
    assert centrality.top(spark.createDataFrame([("a", 1.0)], "node string, pagerank double"), "pagerank", 5, F.col("node")).count() == 1
