"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import materialize


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """node, root for every node of ``edges`` (a, b); root is the smallest node reachable.

    A round links every node's larger neighbours to its smallest (large star), then its
    smaller neighbours and itself to the smallest of them (small star), until nothing
    changes; rounds grow with the logarithm of the longest path. Hot nodes are safe: minima
    combine before the shuffle, and the joins that follow are split by size at run time.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(
        F.col("u") != F.col("v")).distinct()
    now = materialize(now, name)
    mark = None
    while True:
        again = now.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if again == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = again
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(
            small.unionByName(least.select("u", F.col("m").alias("v")))
            .filter(F.col("u") != F.col("v")).distinct(), name)
