"""Queries do the whole job that their operators stand for."""

from __future__ import annotations

import json
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402
from foliograph.plans import reference as R  # noqa: E402
from foliograph.session import read  # noqa: E402

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture
def given(spark, monkeypatch):
    """Some tables made up, the others as they are on the smallest data."""

    def f(**tables):
        monkeypatch.setattr(R, "read", lambda s, d, t: tables[t] if t in tables else read(s, d, t))
        return lambda name: entry.queries()[name](spark, DATA)

    return f


def records(spark, *relationships):
    rels = [{"source": a, "type": t, "target": b, "evidence": [f"{a} needs {b}."], "section_ids": []} for a, t, b in relationships]
    return spark.createDataFrame([(1, "m", json.dumps({"sections": [], "enrichment": {"entities": [], "relationships": rels}}))], "record_id bigint, slug string, payload string")


def loads(spark, *keys):
    rows = [(i, "m", k, k, "Relief", [], ["P1"], 1) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "entity_id bigint, slug string, key string, name string, type string, aliases array<string>, section_ids array<string>, mentions bigint")
    return df.selectExpr("*", "'' as definition", "'primary' as salience", "'m.json' as created_from", "timestamp'2024-01-01' as loaded_at")


@needs_data
def test_edges_are_the_typed_relationships(spark, given):
    run = given(raw_documents=records(spark, ("alpha", "REQUIRES", "beta"), ("beta", "HAS_RATE", "gamma"), ("gamma", "GOVERNED_BY", "alpha")), entities=loads(spark, "alpha", "beta", "gamma"))
    assert {(r.node, r.other, r.type) for r in run("o50_strongest_edges").filter("node < other").collect()} == {("alpha", "beta", "REQUIRES"), ("beta", "gamma", "HAS_RATE"), ("alpha", "gamma", "GOVERNED_BY")}
    assert {(r.src, r.dst, r.type) for r in run("o54_answer_subgraph").collect()} == {("alpha", "beta", "REQUIRES"), ("beta", "gamma", "HAS_RATE"), ("gamma", "alpha", "GOVERNED_BY")}
    assert {(r.node, r.other) for r in run("o51_ego_network").collect()} == {("alpha", "beta"), ("beta", "alpha"), ("beta", "gamma"), ("gamma", "beta")}
    assert {(r.src, r.dst) for r in run("o78_projection").collect()} == {("alpha", "beta"), ("beta", "gamma")}


@needs_data
def test_evidence_is_the_relationships_own(spark, given):
    pages = read(spark, DATA, "sections").filter("error is null").limit(1)
    page = pages.selectExpr("* except (base_path, section_id, text)", "'/internal-manuals/m/p1' as base_path", "'P1' as section_id", "'Here alpha needs beta. And so on.' as text")
    run = given(raw_documents=records(spark, ("alpha", "REQUIRES", "beta"), ("beta", "HAS_RATE", "alpha")), entities=loads(spark, "alpha", "beta"), sections=page)
    assert [tuple(r) for r in run("o49_evidence_sections").collect()] == [("alpha", "beta", "REQUIRES", "p1")]
