"""Connected components of an edge table, without a driver or task that sees a whole component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptloom.storage import materialise


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v) of longs, with root the smallest node reachable.

    Alternates two star contractions until the table stands still, which takes a number of rounds logarithmic in the longest chain.
    Neighbourhoods are reduced to a minimum by a partial aggregation and joined back, so a node with very many neighbours is split.
    """
    now = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = materialise(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
