"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripstar.llm.tables import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(pairs: DataFrame, keep) -> DataFrame:
    """Each neighbour that passes ``keep`` is linked to the smallest node of the neighbourhood."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(least, "u")
    linked = joined.where(keep).select(F.col("v").alias("b"), F.col("m").alias("a"))
    own = least.select(F.col("u").alias("b"), F.col("m").alias("a"))
    return linked.unionByName(own).where("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) of every node of edges (a, b).

    Per step one aggregation, one join and one distinct over the links; a node's links are never
    gathered in one place. Steps grow with the logarithm of the longest path.
    """
    links = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = _state(links)
    while before[0]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = stored(_star(both, F.col("v") > F.col("u")))
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        links = stored(_star(down, F.lit(True)))
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
