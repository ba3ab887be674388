"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _centre(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, comp): for each node of ``links`` (u, v), the smallest node it reaches.

    Each round joins every node's neighbours to its smallest one; both steps are
    a minimum by key and a join, so a node with very many links is combined
    before the shuffle and split by the adaptive join. Self links are ignored,
    repeated links count once, null ends are dropped.
    """
    edges = shared.materialize(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = None
    while True:  # the number of rounds grows with the logarithm of the nodes
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.union(edges.select("v", "u"))
        large = both.where("v > u").join(_centre(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # every row has u > v now
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = shared.materialize(small.where("u <> v").distinct(), "edges")
        shared.discard(edges)
        edges = after
    # settled: stars whose centre is the smallest node
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(edges.select("v", "v").distinct())
