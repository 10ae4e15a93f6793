"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbi.llm.common import by_shuffle, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum of their hashes: one row."""
    return tuple(edges.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) of every node that occurs in ``edges`` (columns u, v of one
    orderable type, no nulls); root is the smallest node of its component.

    Alternating large-star and small-star rounds: every node's larger (then
    smaller) neighbours are tied to the smallest neighbour, until each component
    is a star round its smallest node.  A round is two key joins against one
    minimum per node; minima are combined before the shuffle, and a hub's rows
    are an inner join side that Spark may split.  Each round's edges are written
    to the shared folder, so the plan does not grow and a lost executor costs
    no earlier round.  No self links are needed; an empty table stays empty.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                F.least("u", "v").alias("v")).distinct(), label)
    mark = _mark(edges)
    while True:
        both = _both_ways(edges)
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        # large star: neighbours above u go to the least of u and its neighbours
        large = (by_shuffle(both.where("v > u")).join(lowest, "u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: neighbours below u, and u itself, go to the least of them
        joined = by_shuffle(large).join(lowest, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(lowest.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, label)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
