"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from changevault.session import checkpoint


def merge_roots(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inside a task: ``root`` names each row's class by its first row; links (u, v) of row numbers merge classes. So what a
    group's links connect leaves the task as one row for each member, not for each pair."""
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            return root
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _least(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with the least v of its u. An aggregate and a join, so a hub may have any number of links."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("least")), "u")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) as (id, component), for every id that has a link to another; component is the least id.

    The number of rounds grows with the logarithm of a component's width. Each round is cut off by a checkpoint in
    the shared folder. Repeated links, links in both directions and links of an id to itself change nothing.
    """
    edges = checkpoint(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()
        near = _least(large)
        small = near.select("u", F.col("least").alias("v")).unionByName(
            near.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        ).distinct()
        edges = checkpoint(small)
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
