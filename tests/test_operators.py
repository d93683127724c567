"""Golden cases of the reference operators, worked out by hand, and brute force where SQL says nothing."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest

from foliograph.functions import html
from foliograph.functions import text as T
from foliograph.operators import agent, centrality, chunking, components, folds, graph_model, listing, models, retrieval, vectors
from pyspark.sql import functions as F


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(("name", "key"), [
    ("  The CGT Relief ", "cgt relief"), ("Entrepreneurs’ Relief", "entrepreneurs' relief"), ("TCGA 1992 s.165", "tcga 1992 s.165"), ("A (the) Café, Ltd.", "the caf ltd"), ("the", "the"), (None, ""), ("", ""),
])
def test_norm(spark, name, key):
    assert one(spark, name, T.norm) == key


def test_text_scalars(spark):
    assert one(spark, " a \t b\n", T.clean) == "a b"
    assert one(spark, None, T.word_count) == 0 and one(spark, " a  b\n", T.word_count) == 2
    assert one(spark, "/x/y//", T.last_path_segment) == "y" and one(spark, "", T.last_path_segment) == "manual"
    assert one(spark, "CG15250 - Expenditure", lambda c: T.heading(c, F.lit("CG15250"))) == "Expenditure"
    assert one(spark, "CG15250", lambda c: T.heading(c, F.lit("cg15250"))) == "CG15250"
    assert one(spark, "word " * 20, T.ellipsis).endswith("…")


def test_html():
    page = "<h2>A</h2><p>x <b>y</b>.</p><ul><li>i</li><li>j</li></ul><table><tr><th>k</th><th></th></tr><tr><td>1</td><td>2</td></tr></table>"
    assert html.html_to_text(page).split("\n") == ["A", "", "x y .", "", "- i", "- j", "", "k | ", "1 | 2"]
    assert html.html_to_text("") == html.html_to_text(None) == ""
    assert html.html_to_text("a<script>x</script><div><p>b</p><p>c</p></div></i>d<!-- e -->") == "a\nb\n\nc\n\nd\ne"
    links = '<a href="#x">n</a><a href=" /p ">P</a><a href="/p">P</a><a href="mailto:a@b">m</a>'
    assert html.extract_links(links) == [("/p", "P")]


@pytest.mark.parametrize(("page", "lines"), [
    ("<p>a<!-- no --> b</p><!-- yes -->", ["a b", "", "yes"]), ("x<br>y", ["x", "", "y"]), ("<p>a<p>b</p>c", ["a", "b", "", "c"]), ("<ul></ul>x", ["x"]), ("<ul><li></li><li>a<ul><li>b</li></ul></li></ul>", ["-", "- a b"]),
    ("<ol start=4><li>a</li><li>b</li></ol>", ["1. a", "2. b"]), ("<p>a</p><b>b</b><i>c</i>", ["a", "", "b c"]), ("a<b>b</b>", ["a b"]), ("<table></table>x", ["x"]), ("<table><tr><td>a<table><tr><td>b</td></tr></table></td></tr></table>", ["a b | b", "b"]),
    ("<table><tr><td>a</td><td></td></tr></table><b>z</b>", ["a |", "", "z"]), ("<span><div>a</div></span>b", ["a", "", "b"]), ("</b>x</p>", ["x"]), ("<style>s</style><div>a <script>t</script> b</div>", ["a b"]), ("<pre>a</pre><h3> h </h3>t", ["a", "", "h", "", "t"]), ("a &amp; b &lt;c&gt;", ["a & b <c>"]),
])
def test_html_rules(page, lines):
    got = html.html_to_text(page).split("\n")
    assert [x.rstrip() for x in got] == lines


def test_html_never_nests_too_deep_or_loses_text(spark):
    deep = "<div>" * 5000 + "<p>in</p>" + "</div>" * 5000
    assert html.html_to_text(deep) == "in"
    rng = random.Random(5)
    parts = ["<p>", "</p>", "<b>", "</b>", "<ul>", "<li>", "</li>", "</ul>", "<br>", "<div>", "</div>", "<span>", "</span>", "<h2>", "</h2>", "<!-- c -->"]
    for _ in range(300):
        words = [f"w{i}" for i in range(6)]
        page = "".join(f" {rng.choice(parts)}{rng.choice(parts)} {w}" for w in words)
        got = html.html_to_text(page)
        if "<ul>" not in page:  # a list shows its items only
            assert [w for w in got.split() if w.startswith("w")] == words, page
    texts = ["plain  text\n\n\n\nx ", "a <b>b</b>", None, "", "x &amp; y", "1 < 2", " \u00a0pad\u00a0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(html.text_of_html(F.col("t"))).collect()] == [html.html_to_text(t) for t in texts]
    assert [r[0] for r in df.select(html.links_of_html(F.col("t"))).collect()] == [[]] * len(texts)


def chunk(spark, sizes, budget):
    df = spark.createDataFrame([("d", i, w) for i, w in enumerate(sizes)], "slug string, pos int, words int")
    return [(r.pos, r.piece_no, r.n_words, r.chunk_no) for r in chunking.greedy_chunks(df, budget).orderBy("chunk_no", "pos", "piece_no").collect()]


def test_chunks(spark):
    assert chunk(spark, [4, 5, 3, 12, 2, 9], 10) == [(0, 0, 4, 0), (1, 0, 5, 0), (2, 0, 3, 1), (3, 0, 10, 2), (3, 1, 2, 3), (4, 0, 2, 4), (5, 0, 9, 5)]
    assert chunk(spark, [], 10) == []
    sizes = [random.Random(3).randint(0, 30) for _ in range(200)]
    got = chunk(spark, sizes, 20)
    assert sum(n for _, _, n, _ in got) == sum(sizes)
    per = {}
    for _, _, n, c in got:
        per[c] = per.get(c, 0) + n
    assert max(per.values()) <= 20 and sorted(per) == list(range(len(per)))


def test_halves(spark):
    df = spark.createDataFrame([("a", 0, 199), ("b", 0, 201), *[("c", i, 5) for i in range(3)]], "chunk string, pos int, n_words int")
    got = sorted(tuple(r) for r in chunking.halves(df).select("chunk", "pos", "first_word", "n_words", "half").collect())
    assert got == [("b", 0, 0, 100, 0), ("b", 0, 100, 101, 1), ("c", 0, 0, 5, 0), ("c", 1, 0, 5, 1), ("c", 2, 0, 5, 1)]


MENTION = "slug string, chunk_no int, mention_id int, name string, type string, definition string, aliases array<string>, section_ids array<string>, salience string"


def test_entity_fold(spark):
    rows = [
        ("m", 0, 1, "The CGT Relief", "Relief", "abc", ["CGTR"], ["S1"], "mentioned"),
        ("m", 1, 2, "CGT Relief", "Allowance", "abcd", ["the cgt relief", "X", None], ["S2"], "primary"),
        ("m", 1, 3, "x", None, None, None, None, None), ("m", 2, 4, "Blank", None, None, None, None, None), ("m", 3, 5, None, None, None, None, None, None),
    ]
    got = {r.key: r for r in folds.entity_fold(spark.createDataFrame(rows, MENTION)).collect()}
    r = got["cgt relief"]
    assert (r.name, r.type, r.definition, r.aliases, r.section_ids, r.salience, r.mentions) == ("CGT Relief", "Relief", "abcd", ["CGTR", "X"], ["S1", "S2"], "primary", 2)
    assert (got["blank"].type, got["blank"].salience, got["blank"].aliases) == ("Other", "mentioned", []) and set(got) == {"cgt relief", "blank"}


def test_relationship_fold(spark):
    rows = [("m", 1, "a", "APPLIES_TO", "b", "q1", ["S"]), ("m", 2, "a", "APPLIES_TO", "b", "q1", None), ("m", 3, "a", "APPLIES_TO", "b", "q2", ["R"]), ("m", 4, "a", "APPLIES_TO", "a", "z", None), ("m", 5, "a", "FOO", "b", "z", None), ("m", 6, None, "APPLIES_TO", "b", "", None)]
    df = spark.createDataFrame(rows, "slug string, seq int, source_key string, type string, target_key string, evidence string, section_ids array<string>")
    (r,) = folds.relationship_fold(df).collect()
    assert (r.mentions, r.evidence, r.section_ids) == (3, ["q1", "q2"], ["R", "S"])
    assert folds.dropped_counts(df).first().dropped == 3


def test_salience_never_falls(spark):
    df = spark.createDataFrame([("m", "k", s, 1) for s in ("primary", "mentioned", "secondary")], "slug string, key string, salience string, mentions bigint")
    r = folds.discusses_upsert(df).first()
    assert (r.salience, r.mentions) == ("primary", 3)


def edges(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string, weight double")


def test_weights(spark):
    df = spark.createDataFrame([("a", "b", None), ("a", "b", 0), ("a", "b", 3), ("a", "a", 9), (None, "b", 1)], "src string, dst string, w int")
    assert [tuple(r) for r in centrality.weights(df).collect()] == [("a", "b", 5.0)]


def test_pagerank(spark):
    got = {r.node: r.pagerank for r in centrality.pagerank(edges(spark, [("a", "b", 1.0)])).collect()}
    assert got["b"] == 1 and abs(got["a"] - 0.540541) < 1e-5
    assert {r.pagerank for r in centrality.pagerank(edges(spark, [("a", "b", 1.0), ("b", "a", 1.0)])).collect()} == {1.0}
    plain = centrality.pagerank(edges(spark, [("a", "b", 1.0), ("a", "c", 3.0), ("c", "a", 1.0)]), normalise=False)
    assert abs(plain.agg(F.sum("pagerank")).first()[0] - 1) < 1e-9
    assert centrality.pagerank(edges(spark, [])).count() == 0


def test_components(spark):
    got = {r.node: (r.component, r.component_size) for r in centrality.components(edges(spark, [("a", "b", 1.0), ("b", "c", 1.0), ("d", "e", 1.0)])).collect()}
    assert got == {"a": (0, 3), "b": (0, 3), "c": (0, 3), "d": (1, 2), "e": (1, 2)}
    chain = spark.createDataFrame([(i, i + 1) for i in range(150)] + [(None, 3), (500, 500)], "src int, dst int")
    assert {r.component for r in components.connected_components(chain).collect()} == {0, 500}
    assert components.connected_components(chain.limit(0)).count() == 0


def test_communities(spark):
    groups = [[f"g{g}n{i}" for i in range(6)] for g in range(3)]
    rows = [(a, b, 1.0) for g in groups for a in g for b in g if a < b] + [("g0n0", "g1n0", 1.0), ("g1n1", "g2n0", 1.0)]
    df = edges(spark, rows)
    member = centrality.communities(df)
    found = {r.node: r.community for r in member.collect()}
    assert len(set(found.values())) == 3 and all(len({found[n] for n in g}) == 1 for g in groups)
    assert centrality.modularity(df, member) > 0.5


def test_communities_in_one_task_and_with_joins(spark, rows):
    """The same comes out whichever way a level goes, and a small graph doesn't take jobs for every round."""
    rng = np.random.default_rng(5)
    at = [(f"n{a}", f"n{b}", float(w)) for a, b, w in zip(rng.integers(0, 60, 150), rng.integers(0, 60, 150), rng.integers(1, 4, 150), strict=True)]
    df = edges(spark, at + [("x", "y", 2.0), ("z", "z", 1.0)])
    spark.sparkContext.setJobGroup("communities", "")
    small = rows(centrality.communities(df))
    spark.sparkContext.setJobGroup("other", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("communities")) < 80
    assert ("x", "x") in small and ("y", "x") in small and len({c for _, c in small}) < len(small)
    few = rows(centrality.communities(df, max_iterations=3))
    assert few == rows(centrality.communities(df, max_iterations=3, task_edges=0)) == rows(centrality.communities(df, max_iterations=3, task_edges=100))
    assert centrality.communities(df.limit(0)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(400, 16)).astype("float32")
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(1000, None), (1001, [0.0] * 16), (1002, [1.0]), (1003, data[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>").repartition(5)
    unit = data.astype("float64") / np.linalg.norm(data.astype("float64"), axis=1, keepdims=True)
    assert [r.vec_id for r in vectors.nearest(df, data[0].tolist(), 3).collect()][:2] == [0, 1003]
    queries = df.filter("vec_id % 50 = 0")
    exact = {(r.query_id, r.id) for r in vectors.nearest_of_each(df, queries, 5, 16, block_rows=97).collect()}
    for q in (50, 100, 350):
        s = unit @ unit[q]
        s[q] = -9
        assert {i for a, i in exact if a == q and i < 400} >= set(np.argsort(-s)[:4].tolist())
    near = {(r.query_id, r.id) for r in vectors.InvertedFile(cells=8).fit(df).search(df, queries, 5, probes=6).collect()}
    assert len(near & exact) >= 0.9 * len(exact)
    assert vectors.clamp(0) == 1 and vectors.clamp(99) == 10


def test_retrieval(spark):
    assert retrieval.coerce_ids('["x","x"," ","y"]') == ["x", "y"] and retrieval.coerce_ids("x") == ["x"] and retrieval.coerce_ids(None) == []
    with pytest.raises(ValueError):
        retrieval.coerce_ids('["x"')
    sections = spark.createDataFrame([("d1", "t", "x" * 12_001)], "node_id string, title string, text string")
    wanted = spark.createDataFrame([("d1",), ("d9",)], "node_id string")
    got = {r.node_id: (len(r.text), r.truncated, r.found) for r in retrieval.read_sections(sections, wanted).collect()}
    assert got == {"d1": (12_000, True, True), "d9": (0, False, False)}
    e = spark.createDataFrame([("a", "b", "PART_OF", 3), ("c", "a", "PART_OF", 5), ("a", "h", "PART_OF", 9), ("a", "b", "RELATED_TO", 9)], "src string, dst string, type string, mentions int")
    ents = spark.createDataFrame([("a", "Tax"), ("b", "Tax"), ("c", "Duty"), ("h", "Organisation"), ("n", None)], "key string, type string")
    assert [(r.other, r.relations, r.mentions) for r in retrieval.ego_network(e, ents, "a").orderBy("other").collect()] == [("b", 1, 3), ("c", 1, 5)]
    assert retrieval.strongest_edges(e, 1).filter("node = 'a'").count() == 1


def test_evidence(spark):
    e = spark.createDataFrame([("a", "b", "REQUIRES", ["quote one", "other"]), ("a", "c", "REQUIRES", ["quote one"]), ("a", "d", "REQUIRES", None)], "src string, dst string, type string, evidence array<string>")
    m = spark.createDataFrame([("a", "p2"), ("b", "p2"), ("a", "p1"), ("b", "p1"), ("c", "p3")], "src string, dst string")
    pages = spark.createDataFrame([("p1", "has the other in it"), ("p2", "has quote one"), ("p3", "quote one"), ("p4", None)], "node_id string, text string")
    assert [tuple(r) for r in retrieval.evidence_sections(e, m, pages).collect()] == [("a", "b", "REQUIRES", "p1", "other")]


def test_section_hits(spark):
    hits = spark.createDataFrame([("p1", 0.98765), ("p9", 0.5)], "id string, score double")
    pages = spark.createDataFrame([("p1", "T", "m", "text " * 200)], "node_id string, title string, slug string, text string")
    m = spark.createDataFrame([("a", "p1"), ("b", "p1")], "src string, dst string")
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "key string, name string")
    got = {r.id: r for r in retrieval.section_hits(hits, pages, m, names).collect()}
    assert (got["p1"].score, got["p1"].entities, len(got["p1"].text)) == (0.9877, "A; B", 400) and got["p9"].title is None and got["p9"].entities == ""


def test_build(spark):
    from foliograph.session import read

    import os

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test data")
    g = graph_model.build(read(spark, d, "manuals"), read(spark, d, "sections"), read(spark, d, "entities"))
    n = {r.table_name: r.n for r in graph_model.summary(g).collect()}
    assert n["documents"] == 60 and n["has_section"] == n["sections"] > 0 and n["entity_edges"] == 0


def test_guard(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert retrieval.guarded_sql(spark, "select count(*) as n from t where 'drop; delete' <> ''", {"t": df}).first().n == 2
    for bad in ("create table zz as select 1", "drop view t", "set spark.sql.ansi.enabled=false", "insert into t values (1)"):
        with pytest.raises(Exception):  # noqa: B017
            retrieval.guarded_sql(spark, bad, {"t": df})
    assert spark.catalog.tableExists("t")


def test_models(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, "")], "doc_id int, text string")
    out = models.embed_all(df, lambda: models.HashEmbedder(8), 8, "h").collect()
    assert len({tuple(r.embedding) for r in out if r.doc_id < 3}) == 1 and len(out) == 3

    class Flaky:
        def extract(self, prompt):
            if len(prompt) > 3:
                raise models.TruncatedResponse
            if prompt == "bad":
                raise OSError("down")
            return prompt

    chunks = spark.createDataFrame([("k", "aa\n\nbad"), ("l", "ok")], "key string, prompt string")
    got = {(r.key, r.result, r.error) for r in models.extract_all(chunks, Flaky, sleep=lambda s: None).collect()}
    assert got == {("k", None, "OSError: down"), ("k", "aa", None), ("l", "ok", None)}


def test_agent(spark):
    tables = {"sections": spark.createDataFrame([("d1", "t", "x")], "node_id string, title string, text string"), "edges": None, "entities": None, "mentions": None}
    tools = agent.tools(spark, {k: v for k, v in tables.items() if v is not None})
    script = iter([agent.Reply(calls=[("read_sections", {"section_ids": "d1"}), ("read_sections", {"section_ids": ""})]), agent.Reply(text=json.dumps({"answer": "A", "sources": [1]}))])
    out = agent.answer("q", lambda m: next(script), tools)
    assert out["answer"] == "A" and '"node_id":"d1"' in out["messages"][1]["content"] and "error" in out["messages"][2]["content"]
    assert agent.answer("q", lambda m: agent.Reply(text="plain"), tools)["answer"] == "plain"


def test_listing(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, None), (5, None)], "id int, link string")
    assert sorted(r.id for r in listing.first_seen(df, ["link"], ["id"]).collect()) == [1, 2]
    s = spark.createDataFrame([("m", None), ("m", "e")], "slug string, error string")
    assert listing.incomplete(s).first().fetched == 1
    with pytest.raises(Exception):  # noqa: B017
        listing.assert_complete(s).collect()
    assert [tuple(r) for r in listing.tally(s, "slug").collect()] == [("m", 2, 1)]
    assert graph_model.not_unique(s, "slug").first().n == 2
