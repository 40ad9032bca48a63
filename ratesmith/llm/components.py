"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith.sources.workspace import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest of its neighbours and itself to its larger neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    return both.where("v > u").join(least, "u").select(
        F.col("v").alias("u"), F.least("u", "low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest of its smaller neighbours to them and to itself."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    handed = edges.join(least, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return handed.unionByName(least.select("u", F.col("low").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; links are (u, v), the smallest node names.

    Each round is written to the shared folder; only a count and a checksum reach the driver.
    """
    edges = staged(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        state = edges.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if (state.n, state.sum) == mark or not state.n:
            break
        mark = state.n, state.sum
    centres = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        centres.select(F.col("v").alias("node"), F.col("v").alias("component")))
