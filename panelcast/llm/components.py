"""Connected components of a link table, as Spark jobs (alternating stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import store


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node that has a link.

    Each round hangs the larger neighbours of a node, then the node itself, on
    the smallest neighbour; rounds go as the logarithm of a component's
    diameter. The smallest neighbour comes from a partial aggregation and is
    joined back, so a node with very many links is never gathered in one place.
    """
    edges = store(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lower, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = store(small.unionByName(lower.select("u", F.col("low").alias("v"))).distinct(), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
