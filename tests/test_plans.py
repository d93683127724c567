"""What the physical plans must and must not hold."""

from __future__ import annotations

import os
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")

#: Core queries whose plan is built without running anything long.
LAZY = [n for n in entry.queries() if re.match(r"o(0|1|2|3|4|5|6)", n) and n not in ("o44_alias_resolution", "o57_relationship_fold", "o58_dropped", "o63_edge_upsert", "o67_component_sizes", "o69_relationship_order")]


def plan(spark, name):
    return entry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(("name", "columns"), [("o18_slug", {"page_id", "url"}), ("o22_norm", {"mention_id", "name"}), ("o05_incomplete", {"slug", "error"}), ("o62_discusses", {"slug", "key", "salience", "mentions"}), ("o59_type_counts", {"slug", "type"})])
def test_only_needed_columns_are_read(spark, name, columns):
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name)))
    assert {c.split(":")[0] for c in schema.split(",")} == columns


@pytest.mark.parametrize("name", ["o24_props", "o39_next", "o41_child_edges", "o42_cross_references", "o46_mentioned_in", "o10_attachments"])
def test_texts_of_pages_are_not_read(spark, name):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", plan_text(spark, name))
    columns = {c.split(":")[0] for schema in schemas for c in re.sub(r"<[^<>]*>", "", re.sub(r"<[^<>]*>", "", schema)).split(",")}
    assert columns and "text" not in columns


def plan_text(spark, name):
    df = entry.queries()[name](spark, DATA)
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", ["o50_strongest_edges", "o51_ego_network", "o78_projection", "o79_pagerank", "o80_components"])
def test_no_text_of_pages_in_the_graph(spark, monkeypatch, name):
    """Queries that run jobs before they return: the sections they are given have no text at all."""
    from foliograph.plans import reference as R
    from foliograph.session import read

    monkeypatch.setattr(R, "read", lambda s, d, t: read(s, d, t).drop("text") if t == "sections" else read(s, d, t))
    assert entry.queries()[name](spark, DATA).count() >= 0


def test_filters_reach_the_scan(spark):
    assert re.search(r"PushedFilters: \[[^\]]*IsNull\(error\)", plan(spark, "o23_eligible"))
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(key\)", plan(spark, "o61_entity_upsert"))


def test_folds_combine_before_the_shuffle(spark):
    for name in ("o56_entity_fold", "o61_entity_upsert", "o62_discusses", "o05_incomplete"):
        assert plan(spark, name).count("partial_") > 0, name


def test_python_only_where_it_must_be(spark):
    for name in ("o09_content_key", "o16_clean", "o19_heading", "o22_norm", "o27_salvage", "o41_child_edges", "o56_entity_fold", "o61_entity_upsert", "o72_nearest"):
        assert not re.search(r"Python|Pandas|Arrow", plan(spark, name)), name


def test_modularity_takes_no_jobs_for_every_round(spark):
    spark.sparkContext.setJobGroup("modularity", "")
    assert [r[0] for r in entry.queries()["o81_modularity"](spark, DATA).collect()] == [True]
    spark.sparkContext.setJobGroup("other", "")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("modularity"))
    assert jobs < 200, jobs
