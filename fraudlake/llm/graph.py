"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and two equi-joins on the node; hub nodes are
met by map-side minima and by skew-split joins, and no component is ever
gathered. Rounds are staged in the shared folder, so lineage stays short.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import staged


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (src, dst: long) -> (node, component): the smallest node reachable.

    Only nodes with an edge to another node are returned. Null ends and
    self-loops are ignored; repeated edges count once. Empty edges give an
    empty result. Raises if ``max_rounds`` do not suffice (they grow with the
    logarithm of the longest path, squared at worst).
    """
    e = staged(
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct(), "cc-edges")
    seen = None
    for _ in range(max_rounds):
        e = staged(_small_star(_large_star(e)), "cc-round")
        mark = e.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x"),
                     F.sum(F.expr("xxhash64(v, u) >> 24")).alias("s")).first()
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
    else:
        raise RuntimeError("connected components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its
    neighbours."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = (e.join(low, "u").filter("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def merge_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the classes of ``i[k]`` and ``j[k]`` in ``labels`` (in place; a label
    is the smallest index of its class)."""
    while len(i):
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped
