"""Connected components of a graph given by its edges, by alternating large-star and small-star rounds.

Every round joins the edges with one minimum per node, so a node with very many edges is aggregated before the shuffle
and its edges may be split over tasks. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import discard, saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node it is connected with) for every node of an edge (a, b) that is not a root.

    Edges may repeat, point either way and join a node with itself; nodes are of any type that has an order.
    """
    now = saved(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                "edges")
    before = None
    while True:
        last, now = now, saved(_small_star(_large_star(now).distinct()).distinct(), "edges")
        discard(last)
        state = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
