"""Connected components by alternating stars: each round is two aggregations and two joins
over the edges that are left, stored in the shared folder; nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silkgrain.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node and root for every node of an edge (a, b): root is the smallest node reachable.

    Loops and repeated edges do nothing; without edges there are no rows.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            roots = now.select("b").distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
        before = state
