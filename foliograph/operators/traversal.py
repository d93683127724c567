"""Walks along the edges of the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.operators.skew import grid_join
from foliograph.session import cut


def walked(edges: DataFrame, links: int, start: DataFrame | None = None) -> DataFrame:
    """(start, node, distance) of the nodes reached from each start (node), or from every node, over 1 to `links` edges
    (src, dst). distance is the least number of edges; a node doesn't reach itself. Null ends don't count."""
    steps = cut(edges.select("src", "dst").filter("src is not null and dst is not null and src <> dst").distinct())
    first = steps if start is None else steps.join(start.select(F.col("node").alias("src")).distinct(), "src", "left_semi")
    found = front = cut(first.select(F.col("src").alias("start"), F.col("dst").alias("node"), F.lit(1).alias("distance")))
    for distance in range(2, links + 1):
        onward = steps.select(F.col("src").alias("node"), F.col("dst").alias("to"))
        far = grid_join(front.select("start", "node"), onward, ["node"]).select("start", F.col("to").alias("node")).filter("start <> node").distinct()
        front = cut(far.join(found, ["start", "node"], "left_anti").withColumn("distance", F.lit(distance)).select("start", "node", "distance"))
        found = found.unionByName(front)
    return found


def rates(edges: DataFrame) -> DataFrame:
    """(key, rate, mentions) of the edges that give an entity's rate."""
    return edges.filter(F.col("type") == "HAS_RATE").select(F.col("src").alias("key"), F.col("dst").alias("rate"), "mentions")
