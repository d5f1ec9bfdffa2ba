"""Connected components of a link table, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featpipe.llm.common import written


def _star(edges: DataFrame, name: str) -> DataFrame:
    """Edges (node, other) with the smallest of node and its others as ``least``.

    The minima are written before they are joined back: both sides of the join
    are then plain shuffles, and AQE can split a node with very many edges."""
    least = written(edges.groupBy("node").agg(F.min("other").alias("_least")), name)
    return edges.join(least, "node").withColumn("least", F.least("node", "_least")).drop("_least")


def components(links: DataFrame, a: str, b: str, name: str = "links") -> DataFrame:
    """(node, component) for every node of the links ``a``-``b``; the component
    is its smallest node.

    Alternating large and small stars: every round connects each node's larger
    (then smaller) neighbours to its least neighbour, until every edge leads to
    its component's least node. Minima are aggregated before the shuffle. Each
    step is written to the shared folder."""
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u != v")
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    state, turn = None, 0
    while True:
        turn += 1
        both = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).union(
            edges.select(F.col("v").alias("node"), F.col("u").alias("other")))
        large = _star(both, f"{name}-{turn}a").where("other > node")
        large = large.select(F.col("other").alias("node"), F.col("least").alias("other")).where("node != other").distinct()
        small = _star(written(large, f"{name}-{turn}b"), f"{name}-{turn}c")
        # the others and the node itself, all to the least
        pairs = F.array(*[F.struct(F.col(c).alias("u"), F.col("least").alias("v")) for c in ("other", "node")])
        edges = written(small.select(F.inline(pairs)).where("u != v").distinct(), f"{name}-{turn}d")
        now = edges.agg(F.count(F.lit(1)).alias("n"),
                        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("sum")).first()
        if state == now:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct())
