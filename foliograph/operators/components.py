"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.operators.skew import Split, split_join
from foliograph.session import cut


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every node that has an edge; component is the smallest node of it.

    Rounds of the smallest label among neighbours, each followed by a jump to the label's label, so that long chains
    shorten by doubling. Minima combine before the shuffle, and edges and labels of hubs are joined apart, so that no
    task gets a hub's edges or a large component's nodes. Null ends are ignored, self loops make a component of one, and an empty table gives an empty result.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a is not null and b is not null")
    both = cut(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    edges_to = Split(both, ["b"]).kept()
    while True:
        near = edges_to.join(labels.select(F.col("node").alias("b"), "component")).groupBy("a").agg(F.min("component").alias("m"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        low = cut(low, forget=True)
        to = low.select(F.col("node").alias("component"), F.col("component").alias("next"))
        labels = cut(split_join(low, to, "component").select("node", "old", F.col("next").alias("component")), forget=True)
        if labels.filter("component <> old").isEmpty():
            return labels.select("node", "component")
        labels = labels.drop("old")
