"""Connected components by alternating large-star and small-star rounds (Kiveris et al. 2014).

Every round is joins and partial aggregates over the edge table, written to the shared
folder; the edges are never gathered in one task or on the driver. The result does not
depend on the order of edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import drop_staged, staged

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, root)``: root is the smallest node reachable.

    Only nodes with an edge appear (a self loop is no edge). NULL ends, repeated edges and
    either direction are allowed.
    """
    now = staged(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        sig = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sig == seen:
            break
        seen = sig
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = staged(large, "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        new = staged(small, "cc-edges")
        drop_staged(now)
        drop_staged(large)
        now = new
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    rooted = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
