"""Connected components of an edge table, as Spark joins and aggregates.

Rounds of large-star and small-star contraction: each round shuffles the edges
by node and reduces them with ``min``, so a node with very many edges is
combined before the shuffle, and the number of rounds grows with the logarithm
of the longest chain.  Every round is written to the shared folder, which cuts
the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node that has an edge to a smaller one.

    ``edges``: columns ``a`` and ``b``, long, in any direction; self-edges and
    repeats do no harm.  ``component`` is the smallest node reachable.  Nodes
    that are themselves the smallest, or have no edge, are left out.
    """
    def down(frame: DataFrame) -> DataFrame:
        return frame.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = stored(down(edges), "edges")
    summary = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    for _ in range(most_rounds):
        # Large star: a node links its larger neighbours to its smallest one.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: its smaller neighbours, and itself, link to its smallest one.
        large = down(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = stored(down(small), "edges")
        before, summary = summary, now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == summary:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
