"""Connected components of an edge list by large-star / small-star contraction.

Each round is one grouped minimum and one join on the edges; the edges are
staged on shared storage between rounds. The number of rounds grows with the
logarithm of the component size. Nothing but one fixed-point counter reaches
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import discard, staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs -> ``(id, component)``: smallest id reachable.

    Vertices without an edge do not appear. Self loops and repeated edges are
    ignored; an empty edge list gives an empty result.
    """
    edges = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        contracted = staged(_small_star(_large_star(edges).filter("u <> v").distinct()), "edges")
        # a star forest: every vertex points at one root and no root points on
        open_ends = (contracted.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
                     .unionByName(contracted.select("u").join(contracted.select(F.col("v").alias("u")).distinct(), "u", "left_semi")))
        done = open_ends.isEmpty()
        discard(edges)  # superseded by what was just written
        if done:
            break
        edges = contracted
    roots = contracted.select(F.col("v").alias("id")).distinct()
    return contracted.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component")))
