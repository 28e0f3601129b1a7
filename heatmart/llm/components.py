"""Connected components by alternating stars, each round a written table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from heatmart.llm.common import drop, stored

EDGE = "a long, b long"


def _forest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace a partition's edges by (node, smallest node reached) of its forest."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for part in parts:
        for a, b in zip(part["a"].tolist(), part["b"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    found = [(x, root(x)) for x in up]
    yield pd.DataFrame([(a, b) for a, b in found if a != b], columns=["a", "b"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every node of the edges (a, b): the smallest node reachable.

    Partitions reduce their edges to forests first. Then large stars link each
    node's greater neighbours to its smallest one, small stars the smaller
    ones, until nothing changes. Minima are pre-aggregated and written before
    they are joined back, so Spark can split a node with very many neighbours.
    """
    spark = edges.sparkSession
    edges = (edges.select("a", "b").where("a is not null and b is not null and a <> b")
             .mapInPandas(_forest, EDGE))
    checksum = {"sum": F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))}
    now, was = stored(edges, **checksum)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least, one = stored(both.groupBy("a").agg(F.min("b").alias("m")))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        least, two = stored(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
                 .select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct())
        new, seen = stored(small, **checksum)
        for done in (was, one, two):
            drop(spark, done["path"])
        same = (seen["rows"], seen["sum"]) == (was["rows"], was["sum"])
        now, was = new, seen
        if same:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(
        now.select("b", "b").distinct())
