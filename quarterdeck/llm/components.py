"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is two joins and two aggregations over the links, written to the shared folder. Nothing but a
count and a checksum of the links reaches the driver. Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import discard, staged


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Large star: every larger neighbour of a node moves to the smallest node around it.
    large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # Small star: the node and its smaller neighbours move to the smallest of these.
    moved = large.join(_lowest(large), "u")
    return moved.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a long, b long)`` that isn't the smallest of its component.

    Nulls and self-links take no part, repeated links count once, an empty table gives an empty one. Nodes
    that are missing from the result are their own root.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = _signature(edges)
    while before[0]:
        last, edges = edges, staged(_round(edges), "links")
        discard(last)
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
