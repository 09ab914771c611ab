"""Connected components of a link table, as a DataFrame loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patloom.llm.registry import written


def _stars(edges: DataFrame) -> DataFrame:
    """One round: each node's larger neighbours, then each node's smaller ones, move to its least neighbour.

    `edges` are (a, b) with a > b. Least neighbours are found by a grouped minimum, so that a hub with
    very many links is reduced in each task before it moves.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    # Nodes that are the least of their surroundings keep their larger neighbours through `large`.
    large = large.filter("a > b").distinct()
    down = large.groupBy("a").agg(F.min("b").alias("least"))
    small = large.join(down, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a > b")
    return small.unionByName(down.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the least node of its component.

    Repeated links, links in both directions and links of a node with itself do no harm. Every round
    is a written table; rounds grow with the logarithm of the longest path.
    """
    tidy = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges, last = written(tidy, "links"), None
    while True:
        edges = written(_stars(edges), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
