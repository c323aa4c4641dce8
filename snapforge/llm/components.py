"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (u, v) of longs to (u, v): each node that isn't its component's least, with that least node.

    Every round is aggregates with map-side partial results and equi-joins whose heavy side holds edges and whose other side
    one row a node, so a star centre with a large share of the edges is a skewed join that Spark splits. Each round is
    written to the shared folder; nothing but two counts comes to the driver.
    """
    now = common.stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = common.stage(small.where("u <> v").distinct(), "edges")
        n, nodes = after.agg(F.count("*"), F.count_distinct("u")).first()
        done = n == nodes and after.join(after.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty()
        common.unstage(now)
        now = after
        if done:
            return now
    raise RuntimeError(f"components have not settled after {most_rounds} rounds")
