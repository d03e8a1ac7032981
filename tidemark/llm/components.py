"""Connected components by alternating stars: every node is tied to smaller and smaller neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept


def _smallest(directed: DataFrame) -> DataFrame:
    """(u, v) with the smallest of u and its neighbours; a minimum has a map-side step, so hubs spread."""
    smallest = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return directed.join(smallest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    directed = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(directed).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = _smallest(down)
    others = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(tied.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long); a component is named by its smallest node.

    Loops and repeated edges do no harm; no edges give no rows. The steps are few, as the logarithm
    of the longest chain, and each is written to the shared folder before the next.
    """

    def state(step: DataFrame) -> tuple:
        return tuple(step.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = kept(edges.where("u <> v").distinct())
    before = state(edges)
    while before[0]:
        edges = kept(_small_star(_large_star(edges).distinct()).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
