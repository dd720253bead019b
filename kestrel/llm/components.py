"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut


def _least(e: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours v."""
    return e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (u, v).

    Both steps are a partial minimum and a join on the node, so a node with very
    many neighbours is split by adaptive skew handling.  The state stays linear in
    the edges and is cut through the shared checkpoint folder after each round.
    """
    e = cut(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()  # each node points to something smaller
        small = large.join(_least(large), "u")
        e = cut(small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        # done when every node points to one root and no root points on
        if e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() and \
                e.groupBy("u").count().where("count > 1").isEmpty():
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
