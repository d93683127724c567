"""Parent-child links to full hierarchies by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.functions import ids
from foliograph.operators.references import section_node
from foliograph.operators.skew import grid_join, split_join
from foliograph.session import cut

#: Between the segments of a path; it can't occur in a node id, which is one segment of a URL path.
SEPARATOR = "/"


def newest_pages(sections: DataFrame) -> DataFrame:
    """(node_id, child_sections) of each page whose newest row, by crawled_at then page_id, is a successful fetch."""
    rows = sections.select(section_node(sections).alias("node_id"), "crawled_at", "page_id", "child_sections", F.col("error").isNull().alias("ok")).filter("node_id is not null")
    newest = rows.groupBy("node_id").agg(F.max_by(F.struct("ok", "child_sections"), F.struct("crawled_at", "page_id")).alias("x"))
    return newest.filter("x.ok").select("node_id", "x.child_sections")


def contents_links(pages: DataFrame) -> DataFrame:
    """Distinct (child, parent) of the contents lists, between pages that are there. A list may name its own page."""
    said = pages.select(F.col("node_id").alias("parent"), F.explode("child_sections").alias("x")).select("parent", ids.node_id(F.col("x.section_id"), F.col("x.base_path")).alias("child"))
    there = pages.select(F.col("node_id").alias("child"))
    return said.filter("child is not null").join(there, "child", "left_semi").select("child", "parent").distinct()


def _endless(links: DataFrame) -> tuple[DataFrame, int]:
    """Nodes from which one can go up forever, that is, on a loop or below one; and the rounds that took.

    The pairs of round k are the nodes and their ancestors 2**k links up. A node that isn't endless drops out in the
    round that passes its longest way up. In a round where none drops out, no such node is left: one with a longer
    way would have an ancestor that drops out.
    """
    pairs = cut(links.select(F.col("child").alias("node"), F.col("parent").alias("up")))
    size = lambda: pairs.agg(F.countDistinct("node"), F.count(F.lit(1))).first()
    (left, n), rounds = size(), 0
    while left:
        above = pairs.select(F.col("node").alias("up"), F.col("up").alias("top"))
        pairs = cut(grid_join(pairs, above, ["up"], n=n).select("node", F.col("top").alias("up")).distinct(), forget=True)
        rounds += 1
        now, n = size()
        if now == left:
            break
        left = now
    return pairs.select("node").distinct(), rounds


def _loops(links: DataFrame, endless: DataFrame) -> DataFrame:
    """(node_id, root_id, on_loop) of the endless nodes; root_id is the smallest id on the loop.

    Each node keeps one endless parent: itself if it lists itself, else the smallest. Doubling carries the smallest id
    passed. The nodes pointed at shrink to the loops; they are the loops exactly when their number stays the same for
    a round, and the minima are the loops' when none changes any more.
    """
    up = (
        links.join(endless.withColumnRenamed("node", "child"), "child", "left_semi")
        .join(endless.withColumnRenamed("node", "parent"), "parent", "left_semi")
        .groupBy("child")
        .agg(F.min(F.struct((F.col("child") != F.col("parent")).alias("other"), F.col("parent"))).alias("x"))
    )
    ptr = cut(up.select(F.col("child").alias("node"), F.col("x.parent").alias("up"), F.least("child", "x.parent").alias("low")))
    image, n = -1, ptr.count()
    while True:
        above = ptr.select(F.col("node").alias("up"), F.col("up").alias("top"), F.col("low").alias("top_low"))
        step = cut(split_join(ptr, above, "up", n=n).select("node", F.col("top").alias("up"), F.least("low", "top_low").alias("low"), (F.col("top_low") < F.col("low")).alias("fell")), forget=True)
        now, fell = step.agg(F.countDistinct("up"), F.count_if("fell")).first()
        ptr = step.drop("fell")
        if now == image and not fell:
            break
        image = now
    on = ptr.select(F.col("up").alias("node")).distinct().withColumn("on_loop", F.lit(True))
    low = ptr.select(F.col("node").alias("up"), F.col("low").alias("root_id"))
    return cut(split_join(ptr.select("node", "up"), low, "up", n=n)).join(on, "node", "left").select(F.col("node").alias("node_id"), "root_id", F.coalesce("on_loop", F.lit(False)).alias("on_loop"))


def _trees(nodes: DataFrame, links: DataFrame, endless: DataFrame, rounds: int) -> DataFrame:
    """(node_id, root_id, depth, path) of the other nodes. path is the array of ids from the root to the node.

    A node with several parents hangs under the smallest. Children of roots are done from the start, so no pointer that
    goes on names a root. Each round joins only the pointers that haven't reached a root with all pointers, those at
    nodes with very many below them apart, and doubles the distance, concatenating the path segments.
    """
    tree = nodes.join(endless.withColumnRenamed("node", "node_id"), "node_id", "left_anti")
    parent = links.groupBy("child").agg(F.min("parent").alias("parent"))
    ptr = cut(
        tree.join(parent, tree["node_id"] == parent["child"], "left").select(
            "node_id", F.coalesce("parent", "node_id").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("dist"),
            F.when(F.col("parent").isNull(), F.array("node_id")).otherwise(F.array("parent", "node_id")).alias("path"), F.col("parent").isNull().alias("root"),
        )
    )
    roots = ptr.filter("root").select(F.col("node_id").alias("up"), F.lit(True).alias("at_root"))
    ptr = cut(split_join(ptr, roots, "up", "left", n=ptr.count()).withColumn("done", F.coalesce("at_root", F.lit(False))).drop("root", "at_root"))
    for _ in range(rounds + 1):
        n = ptr.filter(~F.col("done")).count()
        if not n:
            break
        above = ptr.select(F.col("node_id").alias("up"), F.col("up").alias("top"), F.col("dist").alias("more"), F.col("path").alias("head"), F.col("done").alias("top_done"))
        moved = split_join(ptr.filter(~F.col("done")), above, "up", n=n).select(
            "node_id", F.col("top").alias("up"), (F.col("dist") + F.col("more")).alias("dist"),
            F.concat("head", F.slice("path", F.lit(2), F.size("path"))).alias("path"), F.col("top_done").alias("done"),
        )
        ptr = cut(ptr.filter("done").unionByName(moved), forget=True)
    return ptr.select("node_id", F.col("up").alias("root_id"), F.col("dist").alias("depth"), "path")


def hierarchy(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Full hierarchy of `nodes` (node_id) under `links` (child, parent): node_id, root_id, depth, path, on_loop.

    path is the array of node ids from the root down. A node on a loop, or below one, has depth -1, path null and as
    root_id the smallest id on the loop; on_loop tells the two apart. A node that is its own parent is a loop. Null
    ids, repeated links and links to nodes that aren't there don't count. Without nodes the result is empty.
    """
    nodes = nodes.select("node_id").filter("node_id is not null").distinct()
    ends = nodes.withColumnRenamed("node_id", "child"), nodes.withColumnRenamed("node_id", "parent")
    links = cut(links.select("child", "parent").join(ends[0], "child", "left_semi").join(ends[1], "parent", "left_semi").distinct())
    endless, rounds = _endless(links)
    endless = cut(endless)
    trees = _trees(nodes, links, endless, rounds).withColumn("on_loop", F.lit(False))
    if endless.isEmpty():
        return trees
    loops = _loops(links, endless).select("node_id", "root_id", F.lit(-1).alias("depth"), F.lit(None).cast("array<string>").alias("path"), "on_loop")
    return trees.unionByName(loops)


def descendants(tree: DataFrame) -> DataFrame:
    """(node_id, descendant_id, distance) of every node and each node below it, out of the paths; loops have none."""
    at = tree.select(F.col("node_id").alias("descendant_id"), "depth", F.posexplode("path").alias("level", "node_id"))
    return at.filter(F.col("level") < F.col("depth")).select("node_id", "descendant_id", (F.col("depth") - F.col("level")).alias("distance"))


def _reached(tree: DataFrame, links: DataFrame) -> DataFrame:
    """(node_id, descendant_id, distance) of the nodes on and below loops and each other node above them.

    distance is the least number of links. A round joins the pairs up to 2**k links apart with those exactly 2**k
    apart; when it finds no new pair there is none further apart, as a shortest way has pairs at every distance.
    """
    endless = tree.filter("depth < 0").select(F.col("node_id").alias("node"))
    hop = cut(links.filter("child <> parent").select(F.col("child").alias("node"), F.col("parent").alias("up")).distinct())
    pairs = cut(hop.join(endless, "node", "left_semi").withColumn("distance", F.lit(1)))
    n, far, reach = pairs.count(), 1, hop.count()
    while n:
        above = hop.select(F.col("node").alias("up"), F.col("up").alias("top"))
        more = grid_join(pairs, above, ["up"], n=max(n, reach)).select("node", F.col("top").alias("up"), (F.col("distance") + far).alias("distance")).filter("node <> up")
        pairs = cut(pairs.unionByName(more).groupBy("node", "up").agg(F.min("distance").alias("distance")), forget=True)
        now = pairs.count()
        if now == n:
            break
        hop = cut(grid_join(hop, above, ["up"], n=reach).select("node", F.col("top").alias("up")).distinct(), forget=True)
        n, far, reach = now, 2 * far, hop.count()
    return pairs.select(F.col("up").alias("node_id"), F.col("node").alias("descendant_id"), "distance")


def all_descendants(tree: DataFrame, links: DataFrame) -> DataFrame:
    """descendants(tree), and those on and below loops by the links. No node is its own descendant."""
    return descendants(tree).unionByName(_reached(tree, links))


def _loop_paths(tree: DataFrame, links: DataFrame) -> DataFrame:
    """(node_id, path) of the nodes on and below loops: from the first node on a loop above, itself for those on one."""
    endless = tree.filter("depth < 0").select("node_id", "on_loop")
    inner = links.join(endless.filter("not on_loop").select(F.col("node_id").alias("child")), "child", "left_semi").join(endless.select(F.col("node_id").alias("parent")), "parent", "left_semi")
    none = endless.limit(0).select(F.col("node_id").alias("node"))
    return _trees(endless.select("node_id"), inner, none, endless.count().bit_length()).select("node_id", "path")


def with_paths_and_counts(tree: DataFrame, links: DataFrame) -> DataFrame:
    """tree with path as text and n_descendants, on and below loops too; depth and on_loop tell those apart."""
    tree = cut(tree)
    looped = _loop_paths(tree, links).withColumnRenamed("path", "loop_path")
    counts = all_descendants(tree, links).groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))
    path = F.array_join(F.coalesce("path", "loop_path"), SEPARATOR).alias("path")
    return tree.join(looped, "node_id", "left").join(counts, "node_id", "left").select("node_id", "root_id", "depth", path, "on_loop", F.coalesce("n", F.lit(0)).alias("n_descendants"))


def with_descendant_counts(tree: DataFrame) -> DataFrame:
    """tree with path as text and n_descendants; 0 for leaves, -1 on and below loops."""
    counts = tree.select(F.posexplode("path").alias("level", "node_id"), "depth").filter(F.col("level") < F.col("depth")).groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.when(F.col("depth") >= 0, F.coalesce("n", F.lit(0))).otherwise(-1).alias("n_descendants")
    return tree.join(counts, "node_id", "left").select("node_id", "root_id", "depth", F.array_join("path", SEPARATOR).alias("path"), "on_loop", n)
