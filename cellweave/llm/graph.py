"""Connected components by alternating stars; every round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import settle


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step, then one small-star step, over edges (a > b)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b), root being the least node reachable.

    Edges may repeat, point either way or to themselves; nulls link nothing. A node has
    one row. The number of rounds grows with the logarithm of the longest path; a node
    with very many neighbours is met by its least neighbour through a map-side minimum.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = settle(edges), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            break
        edges, before = settle(_stars(edges)), state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)
