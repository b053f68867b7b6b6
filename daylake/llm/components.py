"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.llm.common import keep_table

MAX_ROUNDS = 60


def components(spark: SparkSession, links: DataFrame, tag: str = "components") -> DataFrame:
    """``links(a, b)`` (longs, any direction) -> ``node, component`` (the smallest node reachable) of every node of a link.

    Alternating stars: every node hangs its larger neighbours, then its smaller ones, on the smallest
    node it sees, until nothing changes; the rounds grow with the logarithm of a component's length.
    Each round is written to the shared folder, so lineage stays short.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = keep_table(spark, edges, tag)
    before = None
    for _ in range(MAX_ROUNDS):
        # Large star: neighbours larger than a node go to the smallest node it sees.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = keep_table(spark, small.where("u <> v").distinct(), tag)
        state = edges.select(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        if before == tuple(state):
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
