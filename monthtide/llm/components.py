"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthtide.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b) that isn't the smallest of its component; root is that smallest node.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest of them,
    until every component is one star; the number of rounds grows with the logarithm of its size.
    Only minima per node are taken, so that a node of many edges costs one partly aggregated row per task.
    Edges of a node with itself, doubled edges and nulls change nothing; no edges give no rows.
    """
    star = settled(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    )
    state = _state(star)
    while state[0]:
        ways = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = settled(rest.union(least).distinct())
        if (now := _state(star)) == state:
            break
        state = now
    return star.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first())
