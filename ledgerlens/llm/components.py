"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.session import materialize


def star(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Joins to each row (u, v) of ``edges`` the least neighbour ``m`` of u from ``nodes``."""
    return edges.join(nodes.withColumnRenamed("u", "of_u"), F.col("u") == F.col("of_u")).drop("of_u")


def connected(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b), component being the least id that can be reached.

    Each round hangs the greater neighbours of a node, then the lesser ones, on its
    least neighbour, and drops repeated edges. It ends when no edge changes; then
    all nodes of a component hang on its least one. A round is a few aggregations
    and joins over the edges left, written to the shared folder.
    """
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("u", "n").alias("m"))
        large = star(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = star(large, low).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first()
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before = now
