from __future__ import annotations

import random

import pytest

from foliograph.operators import hierarchy as H


def run(spark, nodes, links):
    df = H.hierarchy(spark.createDataFrame([(n,) for n in nodes], "node_id string"), spark.createDataFrame(links, "child string, parent string"))
    return {r.node_id: r for r in df.collect()}, df


def test_tree_loop_and_below(spark):
    links = [("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("z", "x"), ("s", "s"), ("t", "s"), ("q", "nowhere"), ("b", "a"), ("y", "c")]
    got, df = run(spark, [*"abcxyzstqo", None, "a"], links)
    assert {k: (r.root_id, r.depth) for k, r in got.items()} == {
        "a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "o": ("o", 0), "q": ("q", 0), "x": ("x", -1), "y": ("x", -1), "z": ("x", -1), "s": ("s", -1), "t": ("s", -1),
    }
    assert got["c"].path == ["a", "b", "c"] and got["x"].path is None
    assert {k for k, r in got.items() if r.on_loop} == {"x", "y", "s"}
    assert {tuple(r) for r in H.descendants(df).collect()} == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}
    assert {r.node_id: r.n_descendants for r in H.with_descendant_counts(df).collect() if r.n_descendants} == {"a": 2, "b": 1} | {n: -1 for n in "xyzst"}


def test_empty(spark):
    assert run(spark, [], [])[0] == {}
    assert {k: r.depth for k, r in run(spark, ["a"], [])[0].items()} == {"a": 0}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_walking(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i:03d}" for i in range(120)]
    parent = {n: rng.choice(nodes[: max(1, i)]) if rng.random() < 0.9 else None for i, n in enumerate(nodes)}
    for i in range(40, 75):
        parent[nodes[i]] = nodes[i - 1]  # a long chain
    parent["n010"], parent["n020"] = "n015", "n010"
    parent["n015"] = "n020"
    got, _ = run(spark, nodes, [(c, p) for c, p in parent.items() if p])
    for n in nodes:
        seen, u = [], n
        while u not in seen and parent.get(u):
            seen.append(u)
            u = parent[u]
        if u in seen:
            assert (got[n].root_id, got[n].depth) == (min(seen[seen.index(u) :]), -1)
        else:
            assert (got[n].root_id, got[n].depth, got[n].path) == (u, len(seen), [u, *reversed(seen)])


def test_descendants_on_and_below_loops(spark):
    links = [("b", "a"), ("x", "y"), ("y", "x"), ("y", "b"), ("z", "x"), ("w", "z"), ("s", "s"), ("t", "s")]
    _, df = run(spark, [*"abxyzwst"], links)
    below = spark.createDataFrame(links, "child string, parent string")
    assert {tuple(r) for r in H.all_descendants(df, below).collect()} == {
        ("a", "b", 1), ("a", "y", 2), ("a", "x", 3), ("a", "z", 4), ("a", "w", 5), ("b", "y", 1), ("b", "x", 2), ("b", "z", 3), ("b", "w", 4),
        ("x", "y", 1), ("y", "x", 1), ("x", "z", 1), ("x", "w", 2), ("y", "z", 2), ("y", "w", 3), ("z", "w", 1), ("s", "t", 1),
    }
    got = {r.node_id: (r.path, r.n_descendants) for r in H.with_paths_and_counts(df, below).collect()}
    assert got == {"a": ("a", 5), "b": ("a/b", 4), "x": ("x", 3), "y": ("y", 3), "z": ("x/z", 1), "w": ("x/z/w", 0), "s": ("s", 1), "t": ("s/t", 0)}
