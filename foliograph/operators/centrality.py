"""Weighted projections, PageRank, components and communities of entity graphs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.operators.components import connected_components
from foliograph.operators.numbering import global_numbers
from foliograph.operators.skew import HEAVY_SHARE, Split, split_join
from foliograph.session import cut

#: Relationship and entity types that connect everything and say little.
HUB_EDGES = ("RELATED_TO", "REFERENCES", "EXAMPLE_OF", "ADMINISTERED_BY", "GOVERNED_BY")
HUB_TYPES = ("Organisation", "Jurisdiction")
#: Edges, each counted in both directions, of a graph that one task holds to find communities.
TASK_EDGES = 4_000_000


def projection(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """(src, dst, weight) of the typed edges that say something, between entities that aren't hubs. A null type is
    left out on either side; the weight is the mentions, 1 where null."""
    kept = edges.filter(~F.col("type").isin(*HUB_EDGES)).select(F.col("source_key").alias("src"), F.col("target_key").alias("dst"), F.coalesce("mentions", F.lit(1)).alias("w"))
    plain = entities.filter(~F.col("type").isin(*HUB_TYPES)).select("key")
    kept = kept.join(plain.withColumnRenamed("key", "src"), "src", "left_semi").join(plain.withColumnRenamed("key", "dst"), "dst", "left_semi")
    return weights(kept)


def weights(edges: DataFrame, weight: str = "w") -> DataFrame:
    """(src, dst, weight): parallel edges added up, each at least 1; null and 0 count 1; self loops and edges without
    an end are dropped."""
    rows = edges.filter("src is not null and dst is not null and src <> dst")
    return rows.groupBy("src", "dst").agg(F.sum(F.greatest(F.coalesce(F.nullif(F.col(weight), F.lit(0)), F.lit(1)), F.lit(1)).cast("double")).alias("weight"))


def pagerank(edges: DataFrame, damping: float = 0.85, max_iterations: int = 50, tolerance: float = 1e-8, normalise: bool = True) -> DataFrame:
    """(node, pagerank) of the nodes of (src, dst, weight).

    Starts at 1/n; the mass of nodes without outgoing weight spreads evenly; stops when the changes sum to less than
    the tolerance. Normalised to a greatest value of 1 if asked for, else the values add up to 1. The shares of the
    edges are fixed once; a round is one join, hubs apart, and one sum that combines before the shuffle. An empty table
    gives an empty result.
    """
    edges = cut(edges)
    totals = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    outgoing = Split(edges, ["src"])
    shares = outgoing.join(totals).select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))
    shares = Split(cut(shares), ["src"], like=outgoing)
    nodes = cut(edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct().join(totals.select(F.col("src").alias("node"), F.lit(True).alias("gives")), "node", "left"))
    n = nodes.count()
    if not n:
        return nodes.select("node", F.lit(0.0).alias("pagerank"))
    rank = nodes.select("node", "gives", F.lit(1.0 / n).alias("r"))
    loose = nodes.filter("gives is null").count() / n
    for _ in range(max_iterations):
        got = shares.join(rank.select(F.col("node").alias("src"), "r")).groupBy("dst").agg(F.sum(F.col("share") * F.col("r")).alias("in"))
        base = (1 - damping) / n + damping * loose / n
        new = rank.join(got, rank["node"] == got["dst"], "left").select("node", "gives", (F.lit(base) + damping * F.coalesce("in", F.lit(0.0))).alias("new"), F.col("r").alias("old"))
        new = cut(new, forget=True)
        # what the next round spreads evenly, and how far this one moved, in one pass
        loose, change = new.agg(F.coalesce(F.sum(F.when(F.col("gives").isNull(), F.col("new"))), F.lit(0.0)), F.sum(F.abs(F.col("new") - F.col("old")))).first()
        rank = new.select("node", "gives", F.col("new").alias("r"))
        if change < tolerance:
            break
    return normalised(rank.select("node", F.col("r").alias("pagerank")), "pagerank") if normalise else rank.select("node", F.col("r").alias("pagerank"))


def normalised(df: DataFrame, column: str) -> DataFrame:
    """column divided by its greatest value, found by an aggregate rather than one window over all rows."""
    return df.withColumn(column, F.col(column) / df.agg(F.max(column)).scalar())


def components(edges: DataFrame) -> DataFrame:
    """(node, component, component_size); components are numbered from 0 by size, the greatest first, then by their
    smallest node."""
    labels = cut(connected_components(edges))
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("component_size"))
    numbered = global_numbers(sizes, [F.desc("component_size"), F.asc("component")], "number")
    return split_join(labels, numbered, "component").select("node", F.col("number").alias("component"), "component_size")


def communities(edges: DataFrame, max_levels: int = 10, max_iterations: int = 10, tolerance: float = 1e-4, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, community): modularity communities of the undirected graph (src, dst, weight), after Louvain.

    Every round each node sees the gain in modularity of joining each neighbouring community and moves to the best,
    the smaller label in a tie; in odd rounds only to smaller labels and in even ones only to greater, so that two
    nodes don't swap places forever. A level ends when neither kind of round moves anything or adds `tolerance` to
    modularity, or after max_iterations of both kinds, and keeps the best labels it saw; then communities become nodes
    and it starts again, until a level moves nothing or after max_levels. The three bounds are those usual for Louvain.
    Labels are the smallest node of each community.

    Nodes are numbered in their order. A level of more than `task_edges` edges, each counted in both directions, takes
    joins for every round; from the first level that has no more, one task does all the levels that are left, by the
    same rules, so that what comes out is the same.
    """
    pairs = edges.filter("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "weight").groupBy("a", "b").agg(F.sum("weight").alias("w"))
    flat = cut(pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"), "w").union(pairs.select("b", "a", "w")))
    total, n = flat.agg(F.sum("w"), F.count(F.lit(1))).first()
    nodes = flat.select(F.col("src").alias("node")).distinct()
    if not total:
        return nodes.withColumn("community", F.col("node"))
    member = cut(global_numbers(nodes, [F.asc("node")], "community"))
    for end in ("src", "dst"):
        flat = split_join(flat, member.select(F.col("node").alias(end), F.col("community").alias(f"{end}_id")), end, n=n)
        flat = cut(flat.drop(end).withColumnRenamed(f"{end}_id", end), forget=True)
    graph = flat
    for level in range(max_levels):
        last = (graph.count() if level else n) <= task_edges
        labels = cut(_levels_in_task(graph, float(total), max_levels - level, max_iterations, tolerance)) if last else _moved(graph, float(total), max_iterations, tolerance)
        if labels.filter("node <> label").isEmpty():
            break
        to = labels.select(F.col("node").alias("community"), "label")
        member = cut(split_join(member, to, "community").select("node", F.col("label").alias("community")), forget=True)
        if last:
            break
        a, b = labels.select(F.col("node").alias("src"), F.col("label").alias("s")), labels.select(F.col("node").alias("dst"), F.col("label").alias("d"))
        graph = split_join(cut(split_join(graph, a, "src"), forget=True), b, "dst")
        graph = cut(graph.groupBy(F.col("s").alias("src"), F.col("d").alias("dst")).agg(F.sum("w").alias("w")), forget=True)
    least = member.groupBy("community").agg(F.min("node").alias("least"))
    return split_join(member, least, "community").select("node", F.col("least").alias("community"))


def _levels_in_task(graph: DataFrame, total: float, levels: int, max_iterations: int, tolerance: float) -> DataFrame:
    """(node, label) after all levels, of a graph (src, dst, w) of numbers that one task can hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            src, dst, w = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in parts]) for i in range(3))
            parts.clear()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in louvain(src, dst, w, total, levels, max_iterations, tolerance)], names=["node", "label"])

    return graph.select("src", "dst", F.coalesce("w", F.lit(0.0)).cast("double").alias("w")).repartition(1).mapInArrow(run, "node bigint, label bigint")


def _summed(keys: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of w of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(w[order], first)


def louvain(src: np.ndarray, dst: np.ndarray, w: np.ndarray, total: float, levels: int, max_iterations: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their labels after all levels; what `communities` does with joins, for edges in memory."""
    nodes = np.unique(src)
    src, dst = np.searchsorted(nodes, src), np.searchsorted(nodes, dst)
    names, member = nodes, np.arange(len(nodes))
    for _ in range(levels):
        labels = _moved_in_memory(src, dst, w, len(names), total, max_iterations, tolerance)
        if (labels == np.arange(len(names))).all():
            break
        kept, at = np.unique(labels, return_inverse=True)
        names, member = names[kept], at[member]
        keys, w = _summed(at[src] * len(kept) + at[dst], w)
        src, dst = keys // len(kept), keys % len(kept)
    return nodes, names[member]


def _moved_in_memory(src: np.ndarray, dst: np.ndarray, w: np.ndarray, n: int, total: float, max_iterations: int, tolerance: float) -> np.ndarray:
    """The labels of n nodes after the rounds of one level; step by step what `_moved` does."""
    k = np.bincount(src, w, n)
    loops = w[src == dst].sum()
    across = src != dst
    src, dst = np.r_[src[across], np.arange(n)], dst[across]  # each node has an option of its own, to stay
    w = np.r_[w[across], np.zeros(n)]
    labels = best_labels = np.arange(n)
    best_value, idle = float("-inf"), 0
    for i in range(2 * max_iterations + 1):
        mass = np.bincount(labels, k, n)
        keys, near = _summed(src * n + np.r_[labels[dst], labels], w)
        node, to = keys // n, keys % n
        stay = to == labels[node]
        value = (near[stay].sum() + loops) / total - (mass[labels] * k).sum() / (total * total)
        gain = np.round(near - k[node] * (mass[to] - np.where(stay, k[node], 0.0)) / total, 9)
        may = to <= labels[node] if i % 2 == 0 else to >= labels[node]
        node, to, stay, gain = node[may], to[may], stay[may], gain[may]
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])  # options are in order of node and label
        best = gain == np.maximum.reduceat(gain, first)[node]
        new = labels.copy()
        at, to = node[best][::-1], to[best][::-1]
        new[at] = to  # the last one written is the smallest
        new[node[best & stay]] = labels[node[best & stay]]
        idle = 0 if value > best_value + tolerance else idle + 1
        if value > best_value + 1e-9:
            best_value, best_labels = value, labels
        if idle == 2 or idle and (new == labels).all():
            break
        labels = new
    return best_labels


def _moved(graph: DataFrame, total: float, max_iterations: int, tolerance: float) -> DataFrame:
    """(node, label) after the rounds of one level."""
    degree = cut(graph.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k")), forget=True)
    labels = degree.select("node", "k", F.col("node").alias("label"))
    across = Split(graph.filter("src <> dst"), ["dst"]).kept()
    loops = graph.filter("src = dst").agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
    best_value, best_labels, idle = float("-inf"), labels, 0
    for i in range(2 * max_iterations + 1):  # the last round only tells the value of the one before
        mass = labels.groupBy(F.col("label").alias("to")).agg(F.sum("k").alias("mass"))
        seen = across.join(labels.select(F.col("node").alias("dst"), F.col("label").alias("to"))).groupBy(F.col("src").alias("node"), "to").agg(F.sum("w").alias("w"))
        own = labels.select("node", F.col("label").alias("to"), F.lit(0.0).alias("w"))
        options = _with_mass(seen.unionByName(own).groupBy("node", "to").agg(F.sum("w").alias("w")), mass, total).join(labels, "node")
        rest = F.col("mass") - F.when(F.col("to") == F.col("label"), F.col("k")).otherwise(0.0)
        gain = F.round(F.col("w") - F.col("k") * rest / total, 9)
        order = F.col("to") <= F.col("label") if i % 2 == 0 else F.col("to") >= F.col("label")
        # what is inside the node's community now, for the modularity of the labels before the move
        inside = F.when(F.col("to") == F.col("label"), F.col("w")).otherwise(0.0)
        best = options.select("node", "k", "label", "to", gain.alias("gain"), (F.col("to") == F.col("label")).alias("stay"), order.alias("may"), inside.alias("inside"), F.when(F.col("to") == F.col("label"), F.col("mass")).alias("own"))
        choice = F.when(F.col("may"), F.struct((-F.col("gain")).alias("loss"), (~F.col("stay")).alias("moves"), F.col("to")))
        best = best.groupBy("node", "k", "label").agg(F.min(choice).alias("x"), F.sum("inside").alias("inside"), (F.max("own") * F.col("k")).alias("square"))
        new = cut(best.select("node", "k", F.col("x.to").alias("label"), (F.col("x.to") != F.col("label")).alias("moved"), "inside", "square"), forget=True)
        # the squares of the masses add up over the nodes, each with its own part of its label's
        inside_sum, squares, moved = new.agg(F.sum("inside"), F.sum("square"), F.count_if("moved")).first()
        value = (inside_sum + loops) / total - squares / (total * total)
        idle = 0 if value > best_value + tolerance else idle + 1
        if value > best_value + 1e-9:
            best_value, best_labels = value, labels
        if idle == 2 or idle and not moved:
            break
        labels = new.drop("moved", "inside", "square")
    return best_labels.select("node", "label")


def _with_mass(options: DataFrame, mass: DataFrame, total: float) -> DataFrame:
    """options (node, to, w) with the mass of each label. A label in many options has a great mass, as weights are at
    least 1; labels with a thousandth of all mass are at most a thousand and are broadcast, the others can't be hot."""
    great = mass.filter(F.col("mass") >= total * HEAVY_SHARE).select("to", F.col("mass").alias("great"))
    rows = options.join(F.broadcast(great), "to", "left")
    # options that have their mass are spread by node instead of meeting on the null key
    rows = rows.withColumn("_on", F.when(F.col("great").isNull(), F.struct(F.col("to").alias("k"), F.lit(0).alias("s"))).otherwise(F.struct(F.col("node").alias("k"), F.lit(1).alias("s"))))
    light = mass.filter(F.col("mass") < total * HEAVY_SHARE).select(F.struct(F.col("to").alias("k"), F.lit(0).alias("s")).alias("_on"), F.col("mass").alias("small"))
    return rows.join(light, "_on", "left").select("node", "to", "w", F.coalesce("great", "small").alias("mass"))


def modularity(edges: DataFrame, member: DataFrame) -> float:
    """Modularity of communities (node, community) of the undirected graph (src, dst, weight)."""
    pairs = edges.filter("src <> dst").select("src", "dst", "weight")
    both = cut(pairs.union(pairs.select("dst", "src", "weight")))
    n = both.count()
    at = split_join(both, member.select(F.col("node").alias("src"), F.col("community").alias("cs")), "src", n=n)
    at = cut(split_join(cut(at), member.select(F.col("node").alias("dst"), F.col("community").alias("cd")), "dst", n=n))
    total, inside = at.agg(F.sum("weight"), F.sum(F.when(F.col("cs") == F.col("cd"), F.col("weight")))).first()
    if not total:
        return 0.0
    squares = at.groupBy("cs").agg((F.sum("weight") / total).alias("x")).agg(F.sum(F.col("x") * F.col("x"))).first()[0]
    return (inside or 0.0) / total - squares


def overfetched(ranks: DataFrame, entities: DataFrame, n: int, by: str = "pagerank", factor: int = 4) -> DataFrame:
    """(key, name, type, by, rank): what a trial run shows. The n * factor nodes of highest value come first, then those
    that are hubs or have no type are left out, then the first n remain; so fewer than n come out where the top holds
    many hubs. Values are relative to the greatest that is shown; ties go by key."""
    best = ranks.orderBy(F.desc(by), "node").limit(n * factor)
    shown = best.join(entities.select(F.col("key").alias("node"), "name", "type"), "node").filter(F.col("type").isNotNull() & ~F.col("type").isin(*HUB_TYPES))
    first = shown.orderBy(F.desc(by), "node").limit(n)
    rank = F.row_number().over(W.orderBy(F.desc(by), "node"))  # n rows
    return first.select(F.col("node").alias("key"), "name", "type", (F.col(by) / F.max(by).over(W.partitionBy())).alias(by), rank.alias("rank"))


def top(df: DataFrame, by: str, n: int, *ties: Column | str) -> DataFrame:
    """The n rows with the greatest value, ties by the columns given."""
    return df.orderBy(F.desc(by), *ties).limit(n)
