"""Connected components of an edge table by alternating large and small stars.

Each round joins edges with the smallest neighbour of a node. Minima combine
in map tasks, and the join's hot nodes can be split by adaptive execution, so
a node with a third of all edges is no single group. Rounds are written tables
(recoverable when executors are lost); their number grows with the logarithm of
the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.session import materialize


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none to a smaller one."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    open_ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1")
    return open_ends.count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written before the join, so that adaptive execution can split a hot node there
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (columns a and b): the smallest node reached."""
    edges = materialize(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _settled(edges):
        edges = materialize(_small_star(_large_star(edges).filter("u > v").distinct()).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
