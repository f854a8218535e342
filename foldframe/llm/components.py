"""Distributed connected components by alternating stars.

Large-star links every larger neighbour of a node to the smallest member of
its neighbourhood, small-star links the smaller ones; a few rounds leave each
component as one star around its smallest node. Each round is an aggregate and
a join, written to the shared folder; nothing is gathered on the driver but a
checksum row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved


def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(h, F.lit(1 << 31))), F.bit_xor(h)).first())


def _least(edges: DataFrame) -> DataFrame:
    """Smallest v of each u, materialised so that the join after it reads two
    plain shuffles, which Spark can split where one node has very many edges."""
    return saved(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-least").select(F.col("u").alias("mu"), "m")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node in `edges` (u, v); the component is its
    smallest node. Loops, repeated and null edges are ignored; no edges, no rows."""
    e = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    e = saved(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    seen = None
    while (now := _checksum(e)) != seen and now[0]:
        seen = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both.unionByName(e.select("u", F.col("u").alias("v"))).unionByName(e.select(F.col("v").alias("u"), "v")))
        large = (both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("mu"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        large = saved(large, "cc-large")
        least = _least(large)
        star = large.join(least, F.col("u") == F.col("mu"))
        small = (star.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                 .unionByName(large.join(least, F.col("u") == F.col("mu")).select("u", F.col("m").alias("v"))).distinct())
        e = saved(small, "cc-small")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))).distinct()
