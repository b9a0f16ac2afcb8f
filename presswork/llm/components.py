"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import cut_lineage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """``edges`` are (u, v) with u > v. Every node links its neighbours (large:
    the larger ones, small: the smaller ones and itself) to its least one."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # partial aggregation finds the least neighbour; the join splits hot nodes
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    met = both.join(least, "u")
    if small:
        moved = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        moved = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # the least node itself stays linked to u
        moved = moved.unionByName(least.where("m < u").select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges (a, b)``: the smallest
    node that links reach. Rounds go on until the edges no longer change; each
    star's edges are written to the checkpoint folder, as a plan of both holds
    the edges nine times, and the driver keeps and logs plans."""
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        now = cut_lineage(_star(cut_lineage(_star(now, False)), True))
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
