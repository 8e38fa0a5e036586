"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonehive.llm.store import cut


def _star(pairs: DataFrame) -> DataFrame:
    """Every v of (u, v) is moved to the least node known to u. Minima combine before the shuffle.

    They are written before the join, so that a node with very many edges can be split or sent to all.
    """
    least = cut(pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")))
    return pairs.join(least, F.col("u") == F.col("k")).select("u", "v", "m")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has an edge; component is the least node reachable.

    Loops, repeated edges and null ends are ignored. The number of rounds is logarithmic in the
    longest path; each round is cut by a table in the shared folder, and only whether it was the last
    comes to the driver.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _settled(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = cut(_star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        stars = _star(large)
        small = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(stars.select("u", F.col("m").alias("v")))
        e = cut(small.where("u <> v").distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _settled(e: DataFrame) -> bool:
    """Whether every edge (u, v), v < u, leads to a node from which none leads on, and u has one edge only."""
    ends = e.select(F.col("u").alias("k"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(e.select(F.col("v").alias("k"), F.lit(0), F.lit(1)).toDF("k", "out", "into"))
    open_ones = ends.groupBy("k").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out = 1 and into = 1)")
    return open_ones.isEmpty()
