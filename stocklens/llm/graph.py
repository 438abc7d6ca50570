"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the pairs (a, b): root is the least node reachable.

    Alternates two steps until the pairs no longer change: every node hands its
    larger neighbours, then its smaller ones, to the least node it knows. The
    number of rounds grows with the logarithm of the graph, and pairs never
    multiply. Each round is written out, so a lost executor costs one round.
    """
    edges = stored(edges.where("a != b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select("v", "m").distinct()
        down = large.where("v != m").toDF("u", "v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        small = small.select(F.col("v").alias("a"), "m").union(small.select("u", "m"))
        last, edges = edges, stored(
            small.where("a != m").select("a", F.col("m").alias("b")).distinct(), "edges"
        )
        dropped(last)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
