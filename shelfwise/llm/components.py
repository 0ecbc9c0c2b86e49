"""Connected components of a link table, without ever gathering a node's links in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.checkpoints import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; the component is its smallest node.

    Alternating large-star and small-star steps: each node learns the smallest neighbour by a mergeable ``min``
    and its links are rewired to that one, until every link points straight at the smallest node. The number of
    rounds grows with the logarithm of the longest chain. Null ends and self-links are ignored.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")
    state = None
    while True:
        # Large star: a node's larger neighbours move to the smallest of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("w")).unionByName(
                edges.select("u", F.col("u").alias("w")))
            .join(smallest, "u").filter("w > m").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = stored(large, "large-star")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        )
        edges = stored(small, "small-star")
        found = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"),
                          F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if found == state:
            break
        state = found
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
