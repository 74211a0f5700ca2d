"""Connected components by DataFrame operations: alternating large and small stars.

Each round is two aggregations and joins on the node, so no component is gathered anywhere: a hub's neighbours are
pre-aggregated to their minimum. The minima are written before they are joined back: both sides of the join are then
exchanges of its own, which adaptive execution can split at a hub. Rounds end when a round changes nothing; their number grows with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges(a, b), any comparable type -> (node, component): each node that has an edge to another, with the least node it reaches.

    Null ends and self loops are ignored; repeated edges change nothing; without edges the result is empty."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        now = stored(_small(_large(now)).distinct(), "stars")
        seen = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark or seen[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        mark = seen
    raise RuntimeError(f"components have not settled after {rounds} rounds")
