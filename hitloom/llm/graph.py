"""Connected components by alternating stars, as joins and aggregates of written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.session import settle


def _mark(edges: DataFrame) -> tuple:
    """Tells one edge set from another."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40)))).first())


def components(links: DataFrame) -> DataFrame:
    """Every node of ``links`` (two id columns of one type) with the smallest id it reaches.

    Returns (node, component). Each round hangs a node's larger neighbours on its smallest one,
    then its smaller ones; trees flatten in a number of rounds that grows with the logarithm of
    the nodes. A node's edges are never gathered: its smallest neighbour is an aggregate, joined
    back on, and adaptive execution splits the edges of a frequent node. Rows with a null end and
    loops are left out; repeated links count once; an empty table gives an empty one.
    """
    a, b = links.columns[:2]
    edges = settle(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
