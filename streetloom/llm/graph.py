"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm.common import release, staged


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (u, v: long) that is not its own root.

    The root is the smallest node of the component.  A round is joins and minima only, so a
    node with very many links is never collected, and a join on it can be split.  Rounds end
    when the set of links no longer changes; their number grows with the logarithm of the
    size of a component.
    """
    paths: list = []
    edges = links.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    edges = staged(spark, edges, "links", paths)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")
        ).distinct()
        large = staged(spark, large, "links", paths)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        old = paths
        paths = []
        edges = staged(spark, small, "links", paths)
        release(spark, old)
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
