"""Connected components over an edge table (alternating large star and small star)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs to ``(node, component)``, component the smallest node reachable.

    Every node that has an edge to another one gets a row; null ends and
    loops are left out; an empty table gives an empty one. Each round moves
    every node's neighbours to its smallest neighbour: first the larger ones
    (large star), then the smaller ones (small star). A node with very many
    neighbours costs a partial aggregate and a join that can be split, never a
    collected group. Each round is written to the shared folder, so that a
    lost executor costs one round at most. Rounds grow with the logarithm of
    a component's width; all still open after ``max_rounds`` raises.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges")
    before = _mark(now)
    for _ in range(max_rounds):
        now = stored(_small_star(_large_star(now)), "edges")
        after = _mark(now)
        if after == before:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        before = after
    raise RuntimeError(f"components still change after {max_rounds} rounds")


def _mark(e: DataFrame) -> tuple:
    """Count and order-free checksum of the edge set."""
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def min_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For links between positions of one bounded tile: the smallest position reachable from each."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label[label]
