from __future__ import annotations

import json

from pyspark.sql import functions as F

from foliograph.operators import nested as N


def records(spark, payloads):
    return spark.createDataFrame([(i, p, "clash") for i, p in enumerate(payloads)], "record_id bigint, payload string, text string")


def run(spark, payloads):
    """The elements that have a name of their own; other lists, as those in groups, are levels too."""
    return N.flatten_records(records(spark, payloads)).filter(F.col("element").isin(*N.ELEMENTS.values()))


def keys(df, element=None):
    return sorted((r.record_id, r.element, r.parent_no, r.item_no) for r in df.collect() if element in (None, r.element))


DOC = {
    "sections": [
        {"section_id": "A1", "child_sections": [None, {"section_id": "A2"}], "cross_references": {"href": "A3"}, "attachments": json.dumps([{"url": "u"}, {"url": "v"}])},
        None,
        {"base_path": "/x", "error": "fetch_failed", "childSections": []},
        {"section_id": "B", "child_section_groups": [{"title": "G", "child_sections": [{"section_id": "1"}, None]}, None, {"title": "", "child_sections": None}, {"child_sections": [{"section_id": "3"}]}]},
    ],
    "enrichment": {"entities": {"name": "E"}, "relationships": [{"source": "a", "evidence": ["q", None, "r"]}, {"source": "b", "evidence": "one"}, {"source": "c", "evidence": ""}]},
}
WANT = [
    ("attachment", 0, 0), ("attachment", 0, 1), ("child_section", 0, 1), ("child_section", 3, 0), ("child_section", 3, 2), ("cross_reference", 0, 0), ("entity", -1, 0), ("evidence", 0, 0), ("evidence", 0, 2),
    ("evidence", 1, 0), ("relationship", -1, 0), ("relationship", -1, 1), ("relationship", -1, 2), ("section", -1, 0), ("section", -1, 2), ("section", -1, 3),
]


def test_shapes_and_wrappings(spark):
    text = json.dumps(DOC)
    df = run(spark, [text, json.dumps(text), json.dumps(json.dumps(text)), f"﻿```json\n{json.dumps(DOC, indent=1)}\n```"])
    for i in range(4):
        assert [k[1:] for k in keys(df) if k[0] == i] == WANT


def test_broken_empty_and_null(spark):
    assert keys(run(spark, [json.dumps(DOC)[:-5], "", None, "null", "7", "{}", "[]", '{"sections": null}', '{"sections": "text"'])) == []
    assert keys(run(spark, [])) == []


def test_pages_and_cache_records(spark):
    got = keys(run(spark, [json.dumps({"pages": [{"title": "t"}]}), json.dumps({"key": "k", "result": {"entities": json.dumps([{"name": "x"}, None]), "relationships": None}})]))
    assert got == [(0, "section", -1, 0), (1, "entity", -1, 0)]


def test_tables_keep_their_parents(spark):
    df = N.Flattened(records(spark, [json.dumps(DOC)]))
    child = {r.node_key: r for r in N.flat_table(df, "child_section").collect()}
    sections = {r.node_key for r in N.flat_table(df, "section").collect()}
    assert all(r.parent_key in sections for r in child.values()) and len(child) == 3
    assert child["0:child_section:0:1"].section_id == "A2"
    assert sorted(r.value for r in N.flat_table(df, "evidence").collect()) == ["one", "q", "r"]


def test_long_texts_survive(spark):
    long = "x" * 2_000_000
    df = records(spark, [json.dumps({"sections": [{"text": long}]})])
    assert len(N.flat_table(df, "section").first().text) == len(long)


def test_schema(spark):
    df = spark.createDataFrame([('{"a": [{"b": 1}], "c": "[1]"}',), ('{"a": {"b": null}}',)], "text string")
    got = N.merged_schema(df, "text")
    assert got["a"] == {"list", "object", "field"} and got["a.b"] == {"field", "scalar"} and got["c"] == {"list", "scalar", "field"}
    assert N.canonical("childSections") == "child_sections"


def test_any_number_of_wrappings(spark):
    texts, text = [], json.dumps({"sections": [{"title": "t"}]})
    for _ in range(9):
        texts.append(text)
        text = json.dumps(text)
    assert [k[0] for k in keys(run(spark, texts))] == list(range(9))


def test_every_spelling_and_unknown_lists(spark):
    doc = {
        "pages": [{"sectionId": "A1", "basePath": "/m/a1", "notes": [{"by": "x", "marks": [1, None, 3]}, {"by": "y"}], "meta": {"lastSeen": "2020", "tags": ["p"]}}, {"section_id": "B", "base_path": "/m/b"}],
        "manual": {"slug": "m"}, "deep": {"er": [{"k": 1}]},
    }
    flat = N.Flattened(records(spark, [json.dumps(doc)]))
    assert set(flat.levels) == {"sections", "sections.notes", "sections.notes.marks", "sections.meta.tags", "deep.er"}
    rows = sorted(N.flat_table(flat, "section").collect(), key=lambda r: r.item_no)
    assert [(r.section_id, r.base_path, r.meta_last_seen) for r in rows] == [("A1", "/m/a1", "2020"), ("B", "/m/b", None)]
    notes = {r.node_key: (r.parent_key, r.by) for r in N.flat_table(flat, "sections.notes").collect()}
    assert notes == {"0:sections.notes:0:0": ("0:section:0", "x"), "0:sections.notes:0:1": ("0:section:0", "y")}
    assert [(r.parent_key, r.item_no, r.value) for r in N.flat_table(flat, "sections.notes.marks").orderBy("item_no").collect()] == [("0:sections.notes:0:0", 0, "1"), ("0:sections.notes:0:0", 2, "3")]
    assert [(r.parent_key, r.value) for r in N.flat_table(flat, "sections.meta.tags").collect()] == [("0:section:0", "p")]
    assert [(r.parent_key, r.k) for r in N.flat_table(flat, "deep.er").collect()] == [(None, "1")]
    assert N.flat_table(flat, "attachment").count() == 0


def test_text_that_looks_like_json_stays_text(spark):
    docs = [json.dumps({"sections": [{"text": "[1]", "n": 1}, {"text": "plain", "n": "x"}]}), json.dumps({"sections": {"text": '{"a": 1}'}}), json.dumps([{"sections": [{"text": "t"}]}])]
    flat = N.Flattened(records(spark, docs))
    assert set(flat.levels) == {"sections"}
    assert sorted((r.text, r.n) for r in N.flat_table(flat, "section").fillna("").collect()) == [("[1]", "1"), ("plain", "x"), ("t", ""), ('{"a": 1}', "")]


def test_types_are_read(spark):
    assert N.parsed_type("OBJECT<a: ARRAY<OBJECT<`b c`: STRING, d: DECIMAL(2,1)>>, `x``y`: VARIANT, e: OBJECT<>>") == (
        "OBJECT", {"a": ("ARRAY", ("OBJECT", {"b c": ("STRING",), "d": ("DECIMAL(2,1)",)})), "x`y": ("VARIANT",), "e": ("OBJECT", {})},
    )
    odd = {"sections": [{"we ird": 1, "da-sh": [2], "dot.ted": {"q": 3}, 'quo"te': 4, "": 5}]}
    flat = N.Flattened(records(spark, [json.dumps(odd)]))
    (r,) = N.flat_table(flat, "section").collect()
    assert r["we ird"] == "1" and r["dot.ted_q"] == "3" and r['quo"te'] == "4"
    assert [x.value for x in N.flat_table(flat, "sections.da_sh").collect()] == ["2"]


def test_too_many_fields_are_an_error(spark):
    import pytest

    df = spark.createDataFrame([(json.dumps({f"k{i}": 1 for i in range(50)}),)], "text string")
    with pytest.raises(ValueError, match="fields in one schema"):
        N.merged_schema(df, "text", max_fields=20)


def test_any_depth(spark):
    """Deep fields stay text, and a record of any depth takes none of the others with it."""

    def nest(n, wrap):
        v = 1
        for _ in range(n):
            v = wrap(v)
        return json.dumps({"sections": [{"title": f"t{n} [ {{", "deep": v}]})

    for wrap in (lambda v: {"a": v}, lambda v: [v], lambda v: {"a": [v]}):
        flat = N.Flattened(records(spark, [nest(1, wrap), nest(20, wrap), nest(150, wrap), nest(400, wrap), json.dumps({"sections": [{"title": "x"}]})]))
        assert sorted(r.title.split()[0] for r in N.flat_table(flat, "section").collect()) == ["t1", "t150", "t20", "t400", "x"]
        assert flat.rows.filter("element = 'section'").count() == 5


def test_brackets_in_texts_are_no_depth(spark):
    docs = records(spark, [json.dumps({"a": "[" * 500 + '"' + "{" * 500, "b": ["]"]}), json.dumps({"a": {"b": [1]}})])
    got = N.record_variants(docs, "record_id", "payload").collect()
    assert [r.deep for r in got] == [False, False]
