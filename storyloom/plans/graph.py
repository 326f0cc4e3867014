"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, materialize, skewed_join


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _by_union_find(edges: DataFrame) -> DataFrame:
    """Components of a few edges, on the driver."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    for u, v in edges.collect():
        u, v = top(u), top(v)
        up[max(u, v)] = up[min(u, v)] = min(u, v)
    return edges.sparkSession.createDataFrame([(x, top(x)) for x in up], "node bigint, component bigint")


def connected_components(edges: DataFrame, max_rounds: int = 60, local: int = 0) -> DataFrame:
    """(u, v) bigint edges -> (node, component): the smallest node reachable.

    Alternates large-star and small-star steps; the rounds grow with the logarithm of the longest path.
    Self loops, repeated edges and nulls are allowed and ignored; no edges give no rows.
    Each round is written to the shared folder, and no edge ever reaches the driver, unless there are `local` or fewer.
    """
    edges = edges.filter("u is not null and v is not null and u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "edges")
    before = _state(edges)
    if 0 < before[0] <= local:
        return _by_union_find(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        # large star: every larger neighbour of a node is linked with the smallest of its neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")), "low")
        large = skewed_join(both, low, "u", "n").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # small star: a node's smaller neighbours, and itself, are linked with the smallest of them
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        done, edges = edges, materialize(small.filter("u <> v").distinct(), "edges")
        discard(done, low)
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
