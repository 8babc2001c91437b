"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.session import durable


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node of the edges (u, v) either is a root or hangs on one."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"))
    )
    nodes = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return not nodes.where("ups > 1 OR (ups > 0 AND least = 0)").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of `links` (a, b) can reach.

    Alternates two star steps until every node hangs on its root: first all greater neighbours of a node are tied to
    the smallest of them, then the smaller ones. The number of rounds is logarithmic in the longest path, none for
    links that are stars already. Each step is an aggregate and an equi-join, neighbours are never collected, and
    every round's links are written to the shared folder.
    """
    edges = durable(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = durable(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
