"""Connected components of a link table as repeated contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (long columns a, b); equal
    labels mean the same component.

    Each round maps a node to the smallest of itself and its neighbours, takes
    that step twice, and replaces the links' ends by what they map to; links
    within one node go. Nodes are hashes, so a round leaves a fraction of
    them: rounds grow with the logarithm of the component size. Only the
    shrinking link table is written in each round (which also cuts lineage).
    """
    links = materialize(edges.select("a", "b").where("a <> b").distinct(), "cc-links")
    maps = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = (both.groupBy("a").agg(F.min("b").alias("b"))
               .select(F.col("a").alias("node"), F.least("a", "b").alias("to")))
        step = materialize(low, "cc-step")
        far = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
        step = materialize(step.join(far, "to").select("node", F.col("far").alias("to")), "cc-map")
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        links = materialize(
            links.join(left, "a").join(right, "b").where("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "cc-links")
    if not maps:
        return spark.createDataFrame([], "node long, label long")
    labels = maps[-1].select("node", F.col("to").alias("label"))
    for earlier in reversed(maps[:-1]):
        later = labels.select(F.col("node").alias("to"), "label")
        labels = materialize(earlier.join(later, "to", "left")
                             .select("node", F.coalesce("label", "to").alias("label")), "cc-labels")
    return labels
