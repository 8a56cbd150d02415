"""Connected components of a stored edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.storage import stored


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(v, c) for every vertex of ``edges`` (a, b): c is the smallest vertex of its component.

    Each round takes the smallest label among neighbours, then the label of that label; both joins
    have plain exchanges of stored tables, so a hub with very many edges is split by AQE. Edges with a null
    end take no part; loops and repeated edges change nothing; no edges give no vertices.
    """
    edges = edges.filter("a is not null and b is not null")
    both = stored(spark, edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select("b", "a")), "edges")
    labels = stored(spark, both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("u"), "c").hint("merge"), "u").groupBy("v").agg(F.min("c").alias("m"))
        step = labels.join(near.hint("merge"), "v", "left").select("v", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        step = stored(spark, step, "labels")
        roots = step.select(F.col("v").alias("c"), F.col("c").alias("root"))
        jumped = stored(spark, step.join(roots.hint("merge"), "c", "left").select("v", "old", F.least("c", "root").alias("c")), "labels")
        labels = jumped.select("v", "c")
        if not jumped.filter("c <> old").limit(1).count():
            return labels
