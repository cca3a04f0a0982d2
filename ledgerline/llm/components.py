"""Connected components of an edge table by alternating large-star and small-star steps, each round saved to the shared folder.

A node's smallest neighbour is an aggregate, partly done before the shuffle, and is joined back to the edges, so a node
with a large share of all edges is never a group in one task. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import save


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node that has an edge. edges: longs a and b."""
    pairs = save(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # large star: a node's larger neighbours go to the smallest node around it
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
        wide = pairs.join(least, "b").select("a", F.least("b", "m").alias("b"))
        # small star: a node and its smaller neighbours go to the smallest of them
        near = wide.join(wide.groupBy("a").agg(F.min("b").alias("m")), "a")
        flat = near.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b")).distinct()
        pairs = save(flat, "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
