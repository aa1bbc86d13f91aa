"""Connected components by alternating large and small stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripartite.sources.scratch import write_through


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of ``links`` (a, b): the smallest id it is linked to.

    A large star hangs the greater neighbours of a node under its least neighbour, a small
    star the lesser ones and itself; in turns they end in one star a component, after few
    turns even for long chains. Each turn's edges are written, which cuts the lineage. A
    node with very many links is summed in the map tasks and split by adaptive execution.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = write_through(both.where("a <> b").distinct(), "links")
    while True:
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        large = edges.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = write_through(large.where("a <> b").distinct(), "large_star")
        # Every edge now points from the greater to the lesser node.
        lower = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(lower, "a")
        hung = small.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        own = lower.select("a", F.col("least").alias("b"))
        stars = write_through(hung.unionByName(own).distinct(), "small_star")
        # Done when every node has one edge and every centre has none of its own.
        several = stars.groupBy("a").count().where("count > 1")
        deeper = stars.join(stars.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if several.isEmpty() and deeper.isEmpty():
            found = stars.select(F.col("a").alias("id"), F.col("b").alias("component"))
            centres = stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            return found.unionByName(centres)
        edges = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
