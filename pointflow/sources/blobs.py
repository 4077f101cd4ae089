"""Labelled blobs on which fair and plain centers differ.

Blob i lies around a uniform center in [0, 100]^2. Even blobs have mostly A,
odd ones mostly B; the minority sits a step aside. Every value is a function of
the row id, so nothing is broadcast and any number of rows spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointflow.functions.draws import gaussian_pair, uniform_pair

# fixed values of the generated data
EXTENT = 100.0
SPREAD = 3.0
MINORITY_SHIFT = 5.0
MAJORITY_SHARE = 0.8
DEFAULT_SEED = 42


def blob_layout(ids: DataFrame, n: int, k: int, ident: str = "id") -> DataFrame:
    """Adds `cluster` and `label`: the first n mod k blobs hold one row more than the others."""
    if k < 1 or n < k:
        raise ValueError("need 1 <= k <= n")
    small, longer = divmod(n, k)
    edge = longer * (small + 1)
    i = F.col(ident).cast("bigint")
    size = F.when(i < edge, small + 1).otherwise(small)
    offset = F.when(i < edge, i).otherwise(i - edge)
    cluster = F.expr("div(_offset, _size)") + F.when(i < edge, 0).otherwise(longer)
    majority = F.floor(F.col("_size") * MAJORITY_SHARE)
    in_majority = F.col("_offset") % F.col("_size") < majority
    even = F.col("cluster") % 2 == 0
    return (
        ids.withColumns({"_size": size, "_offset": offset})
        .withColumn("cluster", cluster)
        .withColumn("majority", in_majority)
        .withColumn("label", F.when(even == F.col("majority"), "A").otherwise("B"))
        .drop("_size", "_offset")
    )


def gen_blobs(
    spark: SparkSession, n: int, k: int, seed: int = DEFAULT_SEED, shuffle: bool = False, parts: int | None = None
) -> DataFrame:
    """`id, cluster, label, x, y`; `shuffle` sorts the rows by a draw, which only matters for files."""
    return place_blobs(spark.range(0, n, 1, parts) if parts else spark.range(n), n, k, seed, shuffle)


def place_blobs(ids: DataFrame, n: int, k: int, seed: int = DEFAULT_SEED, shuffle: bool = False) -> DataFrame:
    """`gen_blobs` for rows that are there: each `id` from 0 to n - 1 becomes a point."""
    rows = blob_layout(ids, n, k)
    center = F.col("_center")
    normal = F.col("_normal")
    shift = F.when(F.col("majority"), 0.0).otherwise(MINORITY_SHIFT)
    rows = (
        rows.withColumn("_center", uniform_pair(seed, "center", F.col("cluster")))
        .withColumn("_draw", uniform_pair(seed, "point", F.col("id")))
        .withColumn("_normal", gaussian_pair(F.col("_draw")))
        .select(
            "id",
            "cluster",
            "label",
            F.round(center["u"] * EXTENT + shift + normal["x"] * SPREAD, 3).alias("x"),
            F.round(center["v"] * EXTENT + shift + normal["y"] * SPREAD, 3).alias("y"),
        )
    )
    return rows.orderBy(F.xxhash64("id", F.lit(seed)), "id") if shuffle else rows
