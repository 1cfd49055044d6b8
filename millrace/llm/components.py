"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, staged


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; ``links`` has the long columns a and b.

    Large-star and small-star rounds: each node's neighbours are linked to the smallest one near
    it, until every node is linked to the smallest of its component. All state lies in tables;
    minima are partial aggregates, and joins against them have one row a node on one side, so that a
    hub with very many links can be split.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "links", links.count(), 24)
    while True:
        rows = edges.count()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low", 2 * rows, 24)
        # Each larger neighbour of u, linked to the smallest node near u.
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("w"))
            .join(low, "u")
            .select(F.col("w").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = staged(large, "large", rows, 24)
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least", rows, 24)
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select("e.u", F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        edges = staged(small, "small", 2 * rows, 24)
        # Done when all are stars: no node is linked to one that is linked on.
        inner = edges.select(F.col("v").alias("u")).distinct()
        if gathered(edges.join(inner, "u", "left_semi"), rows, 24).isEmpty():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
