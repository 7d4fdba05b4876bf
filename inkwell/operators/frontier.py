"""Breadth-first crawl order over a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reachable(edges: DataFrame, start: DataFrame, max_depth: int = 10) -> DataFrame:
    """(url, depth) of what links lead to from the start within ``max_depth`` steps.

    A round is an equi-join of the newest level with the edges and an anti-join with what
    was seen; each level is checkpointed, so its lineage does not grow.
    """
    spark = edges.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        from ..sources.scratch import scratch

        spark.sparkContext.setCheckpointDir(scratch(spark, "frontier"))
    seen = start.select("url", F.lit(0).alias("depth")).distinct().checkpoint()
    level = seen
    for k in range(1, max_depth + 1):
        onward = level.select("url").join(edges, F.col("url") == F.col("src")).select(F.col("dst").alias("url")).distinct()
        level = onward.join(seen, "url", "left_anti").withColumn("depth", F.lit(k)).checkpoint()
        if level.isEmpty():
            break
        seen = seen.union(level).checkpoint()
    return seen
