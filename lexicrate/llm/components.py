"""Connected components of a link table by alternating large and small stars.

Each round is two grouped minima and two joins; the edges are written to the
shared folder after every round.  Nodes without links are not in the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.session import store


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every linked node;
    links are undirected; null ends and self links are ignored."""
    edges = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    edges = store(edges, "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(root, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(root.select("hi", F.col("m").alias("lo"))).distinct())
        edges = store(small, "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()


def join_labels(n: int, u: np.ndarray, v: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """For each of ``n`` positions the smallest one it reaches by links (u, v)
    and by an earlier result ``label``."""
    if label is not None:
        u, v = np.concatenate([u, np.arange(n)]), np.concatenate([v, label])
    label = np.arange(n)
    while len(u):
        before = label.copy()
        m = np.minimum(label[u], label[v])
        np.minimum.at(label, u, m)
        np.minimum.at(label, v, m)
        label = label[label]
        if (before == label).all():
            break
    return label
