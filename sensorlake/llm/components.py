"""Connected components by alternating star contraction over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import cut_lineage


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``edges`` (a, b).

    Each round links every node's larger neighbours, then its smaller ones, to the smallest neighbour
    (large star, small star); rounds fall as the logarithm of a component's width. Each round is written
    to the shared checkpoint folder, so lost executors cost one round. Minimums combine before the
    shuffle, and a hub's neighbours are joined back by a join Spark may split, so no group is gathered.
    Ends when a round changes nothing. Empty edges: no rows. Loops (a = b) are ignored.
    """
    star = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    star = cut_lineage(star)
    seen = None
    for _ in range(max_rounds):
        both = star.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            star.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = cut_lineage(low.select(F.col("u").alias("w"), F.least("m", "u").alias("m")))  # a plain side: Spark splits a hub
        large = both.join(low, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # the node itself keeps its link to the smallest
        large = large.unionByName(low.filter("w > m").select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct()
        large = cut_lineage(large)
        low = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("w"), "m"))
        small = large.join(low, F.col("a") == F.col("w"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("w").alias("a"), F.col("m").alias("b"))).filter("a > b").distinct()
        star = cut_lineage(small)
        state = star.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("nodes"),
                         F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        now = (state["n"], state["h"])
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return star.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        star.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
