"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.stage import store


def _least(edges: DataFrame) -> DataFrame:
    """The smallest of each node u and its neighbours v; partial sums keep a hub's links from meeting in one task."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest id that a node is linked to over any number of links. Nodes without links are absent.

    Every round is stored; rounds grow with the logarithm of the longest chain.
    """
    edges = store(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(_least(large), "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = store(small.where("u <> v").distinct())
        after = _mark(edges)
        if after == before:
            break
        before = after
    labels = edges.groupBy("u").agg(F.min("v").alias("label"))
    roots = labels.select(F.col("label").alias("node"), "label").distinct()
    return labels.select(F.col("u").alias("node"), "label").union(roots).distinct()
