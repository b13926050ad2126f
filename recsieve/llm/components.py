"""Connected components by alternating large and small stars, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsieve.llm.common import cut


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b), root being the least node that it is connected with.

    Each round joins every node's edges with its least neighbour: a node's neighbours are never gathered, and a node
    with very many is a skewed join key that Spark splits. Rounds grow as the logarithm of the longest path.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    state = _state(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*")
        edges = cut(small.where("hi <> lo").distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
