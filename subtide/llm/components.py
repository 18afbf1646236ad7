"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from subtide.sources import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets linked to the smallest of the node's neighbourhood."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    linked = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours get linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return linked.unionAll(own).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows of (node, root) for links (a, b): the root is the smallest node of the component.

    Each round is two aggregations and joins over written tables, so Spark can split a hot node; the number
    of rounds grows with the logarithm of the largest distance. Nodes without links are not listed.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct())
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(written(_large_star(edges))))
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
