"""Connected components of a graph given as edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or the not larger) neighbours of each node to the least of its group.

    The least neighbour is an aggregate that is combined before the shuffle, and the join
    that brings it back can be split, so a node may hold any share of the edges.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = pairs.join(least, "a")
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a != b").distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node that has an edge; the component is the least node.

    ``edges`` has columns a and b of one orderable type. Loops, repeated edges and either
    direction are allowed. Each round is written to the shared folder; the number of
    rounds is about the logarithm of the longest path. No edges, no rows.
    """
    now = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        large = _star(_both_ways(now), True)
        after = stage(_star(large, False), "edges")
        # Done when every node hangs on one root, and no root hangs on anything.
        ends = after.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
            after.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("root"))
        )
        roles = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
        open_ = roles.where("up > 1 OR (up > 0 AND root > 0)").limit(1).count()
        now = after
        if not open_:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
