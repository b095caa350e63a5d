"""Connected components of an edge table, by alternating large and small stars.

Every round points each node at the smallest node in its neighbourhood; the number of rounds grows with the logarithm of
the longest chain. Edges are written to the shared folder after each round, which cuts the lineage. Hub nodes are met
only in a grouped minimum (summed up before it is shuffled) and in a join with its result, which is written first: an
aggregate right below a join would keep Spark from splitting a hub's partition. Neither nodes nor links are collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import discard, staged


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def least_neighbours(ends: DataFrame) -> DataFrame:
    """u and m, the smallest node beside it."""
    return staged(ends.groupBy("u").agg(F.min("v").alias("m")), "least")


def large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges after a large star, and the written table that they are read from."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = least_neighbours(both)
    to = F.least("u", "m")
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), to.alias("v")).filter("u <> v").distinct(), least


def small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = least_neighbours(down)
    pairs = down.join(least, "u").select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))))
    return pairs.filter("u <> v").distinct(), least


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """node, root for every node of edges (u, v) that isn't its component's smallest; root is the smallest node."""
    edges = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        large, one = large_star(edges)
        middle = staged(large, "large")
        small, two = small_star(middle)
        last, edges = edges, staged(small, "stars")
        discard(last, middle, one, two)
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots.staged_path = edges.staged_path
    return roots
