"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.base import stored


def _stars(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """One star step: every node ties neighbours (the larger ones, or the smaller ones and itself) to the least it sees."""
    if keep_larger:
        seen = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star-centres")
        tied = seen.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    else:
        # edges run from the smaller node a to the larger node b
        least = stored(edges.groupBy("b").agg(F.min("a").alias("m")), "star-centres")
        tied = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
        tied = tied.unionAll(least.select(F.col("m").alias("a"), "b"))
    return tied.where("a < b").distinct()


def smallest_reachable(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of an edge: the smallest node of its component.

    Alternates large-star and small-star steps until the edges no longer change; every step is
    written to the shared folder.  The number of rounds grows with the logarithm of the longest path.
    """
    current = stored(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(), "edges"
    )
    state = None
    while True:
        print_ = F.expr("sum(cast(xxhash64(a, b) as decimal(20, 0)))")
        now = current.agg(F.count("*"), print_).first()
        if now == state or now[0] == 0:
            break
        state = now
        current = stored(_stars(stored(_stars(current, True), "large-star"), False), "small-star")
    nodes = current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.unionAll(current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
