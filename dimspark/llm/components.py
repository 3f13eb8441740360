"""Connected components of a link table, by alternating star contraction.

Each round hangs the larger neighbours of every node under its least
neighbour (large star), then the smaller ones (small star), until the
links are a forest of stars. Both are a minimum per node and a join with
it: a node with very many links is spread by partial aggregation and, as
the minimum side has one row per node, by AQE's skew join. Nothing is
collected but a checksum.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm.chunks import discard, store


class UnionFind:
    """Union by least element, for the links found inside one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _sum(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    up = least.select("u", F.col("m").alias("v"))
    side = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.unionByName(side).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the least node reachable, for every node with a link."""
    spark = links.sparkSession
    edges = store(
        spark, links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    before = _sum(edges)
    while before[0]:
        old, edges = edges, store(spark, _small_star(_large_star(edges)), "links")
        discard(old)
        now = _sum(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
