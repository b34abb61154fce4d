"""Connected components of links by alternating stars, as joins and partial minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _least(edges: DataFrame) -> DataFrame:
    """(u, least): the smallest of u's neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node that
    it is linked to, over any number of links.

    Each round hangs larger neighbours (large star), then smaller ones (small star),
    below a node's least neighbour, until nothing changes: about log n rounds. A round
    is two grouped minima and joins on the node; a node with very many links is one
    row per task in the minimum and is split in the join by adaptive execution."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        at = both.join(_least(both), "u").withColumn("m", F.least("u", "least"))
        large = at.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        at = large.join(_least(large), "u")  # v < u in every row
        small = at.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(at.select("u", F.col("least").alias("v")))
        edges = small.where("u <> v").distinct().checkpoint()
        was, state = state, edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if was == state:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
