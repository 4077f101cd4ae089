"""Connected components of a distributed edge list, and of the pairs within one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.llm.tables import Scratch

# every round at least halves the longest chain of smaller neighbours; no graph of 64-bit ids needs as many
MAX_ROUNDS = 100


def _lowest(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """`u, v` with the smallest of u and its neighbours as `low`.

    The minimum is an aggregate with a map-side part. It is written, as only a
    join of two plain shuffles can be split where one node has very many
    neighbours.
    """
    low = scratch.keep(edges.groupBy("u").agg(F.min("v").alias("low")), name)
    return edges.join(low.withColumn("low", F.least("u", "low")), "u")


def connected(scratch: Scratch, edges: DataFrame, name: str = "components") -> DataFrame:
    """`node, component` for every node of `edges(a, b)`; a component is named by its smallest node.

    Large-star and small-star rounds in turn, each written to a scratch table.
    Loops and repeated edges do no harm; edges with a NULL end are left out.
    """
    current = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}-0",
    )
    state = None
    for step in range(1, MAX_ROUNDS):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(scratch, both, f"{name}-large").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        small = _lowest(scratch, large, f"{name}-small")
        # a node hands its lowest neighbour to the others, and keeps it itself
        moved = small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        kept = small.select("u", F.col("low").alias("v"))
        following = scratch.keep(moved.union(kept).distinct(), f"{name}-{step}")
        totals = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}-{step - 1}", f"{name}-large", f"{name}-small")
        current = following
        if totals == state:
            break
        state = totals
    else:
        raise RuntimeError("components did not settle")
    pairs = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that it reaches over the pairs."""
    low = np.arange(n)
    while True:
        following = low.copy()
        np.minimum.at(following, i, low[j])
        np.minimum.at(following, j, low[i])
        following = following[following]
        if (following == low).all():
            return low
        low = following
