"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 joined by pairs (a, b): the smallest node of each one's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link; component: its smallest node.

    Only tables of links are kept, in the shared folder; a hub's links are never gathered in one
    task: minima are pre-aggregated, and the joins are plain, so Spark splits a hub's partition.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large)
        low2 = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low2, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select("u", F.col("m").alias("v")))
        new = materialize(small.filter("u <> v").distinct())
        sums = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        for old in (edges, low, large, low2):
            discard(old)
        edges = new
        if sums == state:
            break
        state = sums
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))


def smallest_ids(links: DataFrame, a: str, b: str, classes: DataFrame, *least: str) -> DataFrame:
    """(node, component, and the values ``least`` of the class whose values come first in its component) for every node with a link.

    Classes are known by a ``node`` number of their own, so those that share an id stay apart.
    """
    component = materialize(connected_components(links, a, b))
    first = component.join(classes.select("node", *least), "node").groupBy("component").agg(F.min(F.struct(*least)).alias("first"))
    return component.join(first, "component").select("node", "component", *[F.col(f"first.{c}").alias(f"first_{c}") for c in least])
