"""Connected components of many small or large graphs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.session import cut_lineage


def components(edges: DataFrame, group: Sequence[str]) -> DataFrame:
    """``(group..., node, component)`` for each node of ``edges (group..., a,
    b)``: the smallest node that edges reach.

    Every node points to a smaller one of its component, at first to its least
    neighbour. A round offers each node, and the node that it points to, the
    least pointer's pointer among its neighbours, and doubles the pointers;
    so chains shrink by halves and rounds grow with the logarithm of the
    longest path. A round's pointers are written to the checkpoint folder;
    rounds end when none moves.
    """
    g = list(group)
    both = cut_lineage(edges.select(*g, "a", "b").unionByName(edges.select(*g, F.col("b").alias("a"), F.col("a").alias("b")))
                       .filter("a <> b").distinct())
    to = cut_lineage(both.groupBy(*g, F.col("a").alias("node")).agg(F.min("b").alias("m")).select(*g, "node", F.least("node", "m").alias("to")))
    state = None
    while True:
        # where pointers lead after two steps
        far = (to.join(to.select(*g, F.col("node").alias("to"), F.col("to").alias("far")), [*g, "to"])
               .select(*g, "node", "to", "far"))
        least = (both.join(far.select(*g, F.col("node").alias("b"), "far"), [*g, "b"])
                 .groupBy(*g, F.col("a").alias("node")).agg(F.min("far").alias("least")))
        offers = far.join(least, [*g, "node"]).select(*g, F.inline(F.array(
            F.struct(F.col("node").alias("node"), F.least("far", "least").alias("to")),
            F.struct(F.col("to").alias("node"), F.least("far", "least").alias("to")))))
        to = cut_lineage(offers.groupBy(*g, "node").agg(F.min("to").alias("to")))
        now = to.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*g, "node", "to"))).first()
        if now == state or now[0] == 0:
            return to.withColumnRenamed("to", "component")
        state = now
