"""Connected components of a graph in written tables: distributed union-find by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlake.llm.common import written

ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b); the root is the smallest node of the component.

    Each round needs the smallest neighbour of a node only, so a hub's links are reduced in each
    task and never gathered. The number of rounds grows with the logarithm of the longest path.
    """
    edges = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    for _ in range(ROUNDS):
        # Done when every node points at one root and no root points further.
        inner = edges.select(F.col("b").alias("a")).distinct().join(edges, "a", "left_semi").limit(1)
        many = edges.groupBy("a").count().filter("count > 1").limit(1)
        if not inner.select("a").unionByName(many.select("a")).limit(1).count():
            break
        edges = written(_small_star(_large_star(edges)), "links")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
