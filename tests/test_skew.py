"""Joins and loops with one key on half of the rows, without the session's own handling of skew."""

from __future__ import annotations

import pytest
from foliograph.operators import centrality, components, skew, traversal
from pyspark.sql import functions as F


@pytest.fixture
def plain(spark, monkeypatch):
    """No adaptive execution, no broadcasts but those asked for, and no table too small to be split."""
    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in keep.items():
        spark.conf.set(k, v)


def largest_task(df):
    """Rows of the largest partition of a result and of all."""
    counts = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts), sum(counts)


def half_hot(spark, n=20_000):
    return spark.range(n, numPartitions=8).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join(plain, how):
    rows = half_hot(plain)
    other = plain.range(0, 20_000, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = skew.split_join(rows, other, "k", how)
    want = rows.join(other, "k", how)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    if how == "inner":
        hot, _ = largest_task(got)
        assert hot < 4_000 and largest_task(want)[0] >= 10_000


def test_split_join_without_rows(plain):
    rows, other = half_hot(plain).limit(0), plain.range(3).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    assert skew.split_join(rows, other, "k").count() == 0 and skew.split_join(half_hot(plain), other.limit(0), "k").count() == 0
    with pytest.raises(ValueError, match="share"):
        skew.heavy_keys(rows, ["k"], 0)


def test_grid_join(plain):
    a = half_hot(plain, 400)
    b = plain.range(300).select(F.when(F.col("id") < 100, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"))
    got = skew.grid_join(a, b, ["k"], share=0.1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, a.join(b, "k").collect()))
    assert largest_task(got)[0] < largest_task(a.join(b, "k"))[0]


def star(spark, n=4_000):
    """A hub that half of the edges leave, and a chain."""
    return spark.range(1, n).select(F.when(F.col("id") % 2 == 0, F.lit("hub")).otherwise(F.concat(F.lit("n"), F.col("id"))).alias("src"), F.concat(F.lit("n"), F.col("id") + 1).alias("dst"), F.lit(1.0).alias("weight"))


def test_graph_loops_with_a_hub(plain):
    edges = star(plain)
    ranks = {r.node: r.pagerank for r in centrality.pagerank(edges, max_iterations=5, normalise=False).collect()}
    assert abs(sum(ranks.values()) - 1) < 1e-9
    out = {}
    for r in edges.collect():
        out.setdefault(r.src, []).append(r.dst)
    nodes = sorted(set(out) | {d for v in out.values() for d in v})
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(5):
        loose = sum(rank[n] for n in nodes if n not in out)
        new = dict.fromkeys(nodes, 0.15 / len(nodes) + 0.85 * loose / len(nodes))
        for s, ds in out.items():
            for d in ds:
                new[d] += 0.85 * rank[s] / len(ds)
        rank = new
    assert max(abs(rank[n] - ranks[n]) for n in nodes) < 1e-9
    labels = {r.node: r.component for r in components.connected_components(edges).collect()}
    assert len(labels) == len(nodes) and len(set(labels.values())) == len({labels["hub"]} | {labels[n] for n in nodes})


def test_walk(plain):
    e = plain.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "c"), ("d", "a"), (None, "a"), ("a", "a"), ("a", "b")], "src string, dst string")
    got = {(r.start, r.node): r.distance for r in traversal.walked(e, 2).collect()}
    assert got == {("a", "b"): 1, ("a", "c"): 1, ("b", "c"): 1, ("c", "d"): 1, ("d", "a"): 1, ("a", "d"): 2, ("b", "d"): 2, ("c", "a"): 2, ("d", "b"): 2, ("d", "c"): 2}
    some = traversal.walked(e, 3, plain.createDataFrame([("b",)], "node string")).collect()
    assert {(r.start, r.node): r.distance for r in some} == {("b", "c"): 1, ("b", "d"): 2, ("b", "a"): 3}


def test_references_to_one_live_page(plain):
    """A page in order that half of the references name costs no task its references."""
    from foliograph.operators import references as R

    refs = plain.range(8_000, numPartitions=4).select(
        F.lit("t").alias("table_name"), F.lit("f").alias("ref_field"), F.col("id").alias("row_id"),
        F.when(F.col("id") % 2 == 0, F.lit("live")).when(F.col("id") % 5 == 0, F.lit("gone")).otherwise(F.concat(F.lit("m"), F.col("id"))).alias("target_id"), F.lit("2024-05-01").cast("timestamp").alias("at"),
    )
    states = plain.createDataFrame([("live", False), ("gone", True)], "node_id string, gone boolean").withColumn("first_ok", F.lit("2024-01-01").cast("timestamp"))
    got = R.orphan_references(refs, states)
    assert {(r.fault, r["count"]) for r in got.groupBy("fault").count().collect()} == {("gone", 800), ("missing", 3200)}
    verdicts = R._verdicts(R._aggregated(refs, "month"), states, 0.001)
    assert sorted((r.target_id, r.fault) for r in verdicts.filter("heavy").collect()) == [("gone", "gone"), ("live", None)]
    counts = R.orphan_counts(refs, states).collect()
    assert {(r.fault, r.n_refs, r.n_targets) for r in counts} == {("gone", 800, 1), ("missing", 3200, 3200)}


def test_a_page_with_half_of_all_children(plain):
    from foliograph.operators import hierarchy as H

    n = 3_000
    links = [(f"c{i}", "mid" if i % 2 else f"c{i - 1}") for i in range(1, n)] + [("mid", "top"), ("top", "root")]
    nodes = plain.createDataFrame([(x,) for x in {a for pair in links for a in pair} | {"alone"}], "node_id string")
    got = {r.node_id: (r.root_id, r.depth, "/".join(r.path)) for r in H.hierarchy(nodes, plain.createDataFrame(links, "child string, parent string")).collect()}
    assert got["c1"] == ("root", 3, "root/top/mid/c1") and got["c2"] == ("root", 4, "root/top/mid/c1/c2") and got["alone"] == ("alone", 0, "alone")
    assert len(got) == n + 3 and {r for r, _, _ in got.values()} == {"root", "alone"}
