"""Connected components by alternating large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _join_minimum(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with ``m``, the smallest of u and its v.

    The minima are a partial aggregate with one row per u, so a node with a third of
    all edges is one small row there, and AQE may split its side of the join.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("_m"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "_m").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _join_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    linked = _join_minimum(down)
    moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node.

    Self loops, repeated edges and either direction are allowed; rows with a null end
    are left out; no edges give no rows.  Every round is written to the scratch folder,
    so neither plans nor lineage grow.
    """
    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    edges = scratch.write(down.distinct(), "edges")
    before = state(edges)
    for _ in range(max_rounds):
        edges = scratch.write(small_star(large_star(edges)), "stars")
        now = state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Per place 0..n-1 the smallest place it is connected to by the pairs (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
