"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of edges ``a, b`` (numbers); the root is the smallest node.

    Alternates two star steps: every node links its larger, then its smaller neighbours to
    the smallest node near it. The number of rounds grows with the logarithm of the longest
    path. Each round is written, so a lost executor repeats a round at most. Edges of a node
    to itself or to NULL, and repeated edges, change nothing.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, before = staged(pairs, "edges"), None
    while True:
        state = tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        large = both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        large = staged(large, "edges")
        near = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(near, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u != v")
        pairs = staged(small.unionByName(near.select("u", F.col("least").alias("v"))).distinct(), "edges")
