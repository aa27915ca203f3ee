"""Connected components of a link table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.cluster import cut, release


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """links(a, b) -> (node, component), component being the smallest node reachable.

    Every round hands each node the smallest label around it, then jumps to the
    label's label, so that long chains shrink geometrically and stars settle at once. Groups are reduced by partial aggregation before they are shuffled: a
    hub costs one row per task. Null ends and loops are ignored; an empty table
    gives an empty result.
    """
    links = links.select("a", "b").where("a <> b")
    edges = cut(links.union(links.select("b", "a")).distinct())
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component"))

    def around(labels: DataFrame) -> DataFrame:
        return (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )

    labels = cut(labels)
    for _ in range(rounds):
        lower = labels.join(around(labels), "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("via")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        following = cut(
            lower.join(jump, "via").select("node", "old", F.least("via", "far").alias("component"))
        )
        labels = following.select("node", "component")
        release(links.sparkSession)
        if following.where("component <> old").isEmpty():
            return labels
    raise RuntimeError("components did not settle; raise `rounds`")
