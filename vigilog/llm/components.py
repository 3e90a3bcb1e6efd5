"""Connected components of a link table, by alternating star contractions.

Each round hangs every node on the smallest node its neighbours know (large star, then small
star), so the number of rounds grows with the logarithm of the longest path. Both stars
of a round are tables in the shared folder: a lost executor costs no more than its tasks, and the
driver never plans more than one star at a time. It holds no link either: stars are joined by shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.operators.joins import join_least
from vigilog.sources.lake import materialise, scratch_path, scratch_scope


def _large_star(edges: DataFrame) -> DataFrame:
    up = edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    both = up.union(edges.select("high", "low"))
    # A node with very many neighbours is spread over salts of these.
    hung = join_least(up, both, "node", "other", "other", "least")
    return hung.select(F.col("other").alias("high"), F.least("least", "node").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    hung = join_least(edges, edges, "high", "low", "low", "least")
    centres = edges.groupBy("high").agg(F.min("low").alias("low"))
    return hung.where(F.col("low") != F.col("least")).select(F.col("low").alias("high"), F.col("least").alias("low")).union(centres).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("high", "low").cast("long")), F.sum(F.col("low") % 1_000_003)).first())


def connected(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node that has a link to another node.

    The component is its smallest node. Links with a null end, loops and repeated links
    change nothing; without links there are no rows.
    """
    spark = links.sparkSession
    a, b = F.col(left), F.col(right)
    edges = links.where(a != b).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()
    edges = materialise(edges, scratch_path(spark, "links"))
    before = _state(edges)
    while before[0]:
        path = scratch_path(spark, "stars")
        with scratch_scope(spark):
            hung = materialise(_large_star(edges), scratch_path(spark, "large-stars"))
            edges = materialise(_small_star(hung), path)
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return members.union(edges.select("low", "low").distinct())
