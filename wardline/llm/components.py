"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import stage, unique_key_join


def _lowest(edges: DataFrame, node: str, other: str) -> DataFrame:
    """node, low (its smallest neighbour or itself), degree."""
    return edges.groupBy(F.col(node).alias("node")).agg(
        F.least(F.min(node), F.min(other)).alias("low"), F.count("*").alias("degree")
    )


def _star(edges: DataFrame, node: str, other: str, total: int) -> DataFrame:
    """Edges from the nodes' neighbours, and from the nodes, to the nodes' lowest neighbours."""
    low = stage(_lowest(edges, node, other), "component-low")
    met = unique_key_join(edges.select(F.col(node).alias("node"), F.col(other).alias("other")), low, "node", "degree", total)
    pairs = met.select(F.explode(F.array(F.struct("other", "low"), F.struct(F.col("node").alias("other"), "low"))).alias("e"))
    pairs = pairs.select(F.col("e.other").alias("a"), F.col("e.low").alias("b")).filter("a <> b")
    return stage(pairs.distinct(), "component-edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is its component's smallest node.

    Large and small stars in turn: each node's greater neighbours, then its smaller ones, are
    hung on its lowest neighbour, until every edge leads to a root. Lowest neighbours are sums per
    node, nodes of many edges are joined by broadcast (`unique_key_join`); each step is a staged
    table. Rounds grow with the logarithm of the number of nodes.
    """
    down = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(edges.filter("a <> b").select(down.alias("e")).select("e.a", "e.b").distinct(), "component-edges")
    state = None
    while True:
        total, check = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not total or (total, check) == state:
            break
        state = total, check
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(stage(both, "component-both"), "a", "b", 2 * total)
        # Now a > b everywhere: lowest neighbours are at most the node itself.
        large = large.filter("a > b")
        count = large.count()
        edges = _star(large, "a", "b", count).filter("a > b")
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
