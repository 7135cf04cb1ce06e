"""Connected components of an edge table by alternating large-star and small-star steps.

Every step joins two written tables, so a hub's edges are split by AQE; minima are
aggregated partially. Nothing but one count per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import written


def _stars(edges: DataFrame) -> bool:
    roles = edges.select("a", F.lit(1).alias("out")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("out")))
    odd = roles.groupBy("a").agg(F.sum("out").alias("n"), F.min("out").alias("root")).where("n > 1 or (n = 1 and root = 0)")
    return odd.limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest node of its
    component. Loops and repeated edges are allowed."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    # Done when the edges are stars: no node has two targets or is a target itself.
    while not _stars(now):
        # Large star: every larger neighbour of a node is linked to the smallest of the neighbourhood.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = written(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        now = written(large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                      .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
