"""Connected components of an edge table, without leaving the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import materialize

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node of `edges` (u, v).

    Alternates the large and the small star: every node hands its neighbours the smallest of them, until all
    edges lead to a root. Each round is stored. Edges with a null end or between a node and itself link nothing.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = materialize(edges), None
    for _ in range(MOST_ROUNDS):
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("low"))
        large = (
            both.where("v > u")
            .join(least, F.col("u") == F.col("at"))
            .select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
            .distinct()
        )
        least = large.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("low"))
        small = large.join(least, F.col("u") == F.col("at")).where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = materialize(small.union(least.select("at", "low")).distinct())
    raise RuntimeError("the components did not settle")
