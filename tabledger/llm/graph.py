"""Connected components of a table of edges, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node of its component) for every node that has an edge.

    Alternates large-star and small-star steps: each replaces a node's edges by edges to the smallest node around it,
    so a component of any shape becomes a star in a number of rounds that grows with the logarithm of its size. A
    step is one minimum per node and one join, both of which Spark can split for a node with very many edges.
    """
    now = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        after = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = written(after, "edges")
        was, mark = mark, _mark(now)
        if mark == was:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return row["n"], row["h"]
