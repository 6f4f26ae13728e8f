"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import write_scratch


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the greater (large star) or the smaller neighbours of every node to its least one."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = edges.join(least, "u")
    if large:
        return tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = tied.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); the component is its smallest node.

    Every round works on tables of edges and joins on the node, so a node with very
    many edges is a skewed join, which Spark splits. The rounds grow with the
    logarithm of the longest path. Edges with a null end or from a node to itself
    count for nothing; repeated edges count once.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    known = edges.where(F.col("u") != F.col("v")).select(u.alias("u"), v.alias("v")).distinct()
    known = write_scratch(known, "edges")
    state = None
    while True:
        # Edges run from the greater node u to the smaller node v.
        now = known.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
        if state == (now["n"], now["x"]) or not now["n"]:
            return known.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                known.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = (now["n"], now["x"])
        large = _stars(known, True).distinct()
        known = write_scratch(_stars(large, False).distinct(), "edges")
