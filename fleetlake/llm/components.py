"""Connected components of a graph that is nowhere held as a whole."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import stored


#: Bytes of an edge.
EDGE_BYTES = 16


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that link every node of the given edges to the smallest of its component, itself left out."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, longs) but the roots: its component's smallest node.

    Rounds of two steps, each a minimum per node and a join: every node hands the smallest of its
    neighbours and itself to its larger neighbours, then to its smaller ones. Both keep components
    and end with stars around the smallest nodes. A minimum is pre-aggregated before the shuffle, and the
    engine splits hot nodes in the join. Every step is stored in the shared folder, in files of the size of its edges.
    ``edges`` should be stored, for they are counted here.
    """
    count = edges.count()
    edges = _ordered(edges.select("a", "b"))
    known = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stored(_ordered(large), "star-large", EDGE_BYTES * count)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stored(_ordered(small.union(least.select("a", "least"))), "star-small", EDGE_BYTES * count)
        seen = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == known:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        known, count = seen, seen[0]


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once, without loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
