"""Connected components by alternating large and small stars.

Edges shrink to stars around the least node of each component; nothing but
counts and checksums comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import written


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges ``a > b``."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (the least node) for every node with an edge to
    another; ``edges`` has integer columns ``a`` and ``b`` in any order, repeats
    and loops included. No edges give no rows. Each round is written to the
    shared folder, so a lost executor costs at most one round."""
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = written(oriented, name)
    mark = None
    while True:
        sums = state.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (sums["n"], sums["x"]) == mark or sums["n"] == 0:
            break
        mark = (sums["n"], sums["x"])
        state = written(_stars(state), name)
    centres = state.select(F.col("b").alias("node")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres.select("node", F.col("node").alias("component")))
