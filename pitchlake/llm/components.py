"""Connected components by alternating large-star and small-star rounds.

Each round rewires every edge towards the smallest neighbour seen; star
centres of any degree are handled by a partial aggregate and a join that AQE
can split. Rounds are written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import written


def _large(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(low, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (smallest node of the component) for every node that has an edge.

    ``edges`` has long columns ``a`` and ``b``; self loops and repeats do no harm."""
    e = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        e = written(_small(_large(e)), "edges")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if seen == now:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
