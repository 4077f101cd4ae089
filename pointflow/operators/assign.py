"""Nearest-center assignment.

Every form is row-local: the K centers travel inside the plan, the points are
neither shuffled nor keyed. All forms sum the coordinates in the same order and
give the lowest index on ties, so they return the same bits.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointflow.functions.vectors import flat_table_text, sqdist, sqdist_text, table_text

STRATEGIES = ("auto", "unrolled", "lambda", "arrow")
# K * D up to which generated arithmetic beats Arrow; above it the generated method is too long to be compiled
UNROLLED_CELLS = 24
# cells of one distance block inside a task: points are cut so that it stays in cache
BLOCK_CELLS = 1 << 16
# centers live on the driver, in every task and as text in the plan, so this is far below what pyspark.ml takes
MAX_CENTER_BYTES = 32 << 20

Centers = Sequence[Sequence[float]]


def as_centers(centers: Centers) -> list[list[float]]:
    """Checked copy of a center set: not empty, one width, finite, and small enough to ship."""
    rows = [[float(v) for v in c] for c in centers]
    if not rows or not rows[0]:
        raise ValueError("a center set needs at least one center with one coordinate")
    if any(len(r) != len(rows[0]) for r in rows):
        raise ValueError("centers differ in their number of coordinates")
    if not np.isfinite(rows).all():
        raise ValueError("centers must be finite")
    if len(rows) * len(rows[0]) * 8 > MAX_CENTER_BYTES:
        raise ValueError("center set too large to send to every task")
    return rows


def centers_frame(spark, centers: Centers) -> DataFrame:
    """`(k, center)`, one row per center."""
    rows = as_centers(centers)
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "k int, center array<double>")


def collect_centers(df: DataFrame, center: str = "center", order: str = "k") -> list[list[float]]:
    """A center table as a checked list.

    Rows whose cells, counted up to them, go beyond the bound are cut off where
    they are made, so in one pass nothing larger than a center set comes to the
    driver, and a larger one is refused.
    """
    most = MAX_CENTER_BYTES // 8
    rows = df.select(order, center).orderBy(order).limit(most + 1)
    cells = F.sum(F.size(center)).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    found = rows.withColumn("__before", F.coalesce(cells, F.lit(0))).where(F.col("__before") <= most).collect()
    if found and found[-1]["__before"] + len(found[-1][center] or ()) > most:
        raise ValueError("center set too large to send to every task")
    return as_centers([r[center] for r in found])


def pick_strategy(k: int, dims: int) -> str:
    """Measured: lambdas are interpreted and lose to Arrow at every size; they stay as a form without Python."""
    return "unrolled" if k * dims <= UNROLLED_CELLS else "arrow"


def nearest_in_block(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest squared distance and its lowest index for each row of `points`."""
    n, dims = points.shape
    step = max(1, BLOCK_CELLS // len(centers))
    dist2 = np.empty(n)
    index = np.empty(n, dtype=np.int32)
    for lo in range(0, n, step):
        part = points[lo : lo + step]
        total = np.zeros((len(part), len(centers)))
        diff = np.empty_like(total)
        for j in range(dims):
            np.subtract(part[:, j, None], centers[None, :, j], out=diff)
            np.multiply(diff, diff, out=diff)
            total += diff
        best = total.argmin(axis=1)
        index[lo : lo + step] = best
        dist2[lo : lo + step] = total[np.arange(len(part)), best]
    return dist2, index


def matrix_of(column, dims: int) -> np.ndarray:
    """An Arrow list column as an (n, dims) array; refuses missing points and coordinates, and other widths."""
    lengths = np.diff(column.offsets.to_numpy())
    if column.null_count or (lengths != dims).any():
        raise ValueError(f"a point does not have {dims} coordinates")
    if column.flatten().null_count:
        raise ValueError("a point has a NULL coordinate")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _nearest_udf(centers: list[list[float]]):
    table = np.asarray(centers)

    @F.arrow_udf("struct<dist2: double, k: int>")
    def nearest(point: pa.Array) -> pa.Array:
        dist2, index = nearest_in_block(matrix_of(point, table.shape[1]), table)
        return pa.StructArray.from_arrays([pa.array(dist2), pa.array(index)], names=["dist2", "k"])

    return nearest


def whole_text(point: str, dims: int, value: str) -> str:
    """`value`, or an error for a point of another width or without one of its coordinates.

    All forms of assignment refuse the same points, whatever K and D.
    """
    if dims <= UNROLLED_CELLS:
        missing = " OR ".join(f"get({point}, {j}) IS NULL" for j in range(dims))
    else:
        missing = f"exists({point}, v -> v IS NULL)"
    inner = f"if({missing}, raise_error('a point has a NULL coordinate'), {value})"
    return f"if(size({point}) <=> {dims}, {inner}, raise_error('a point does not have {dims} coordinates'))"


def assign_nearest(
    points: DataFrame,
    centers: Centers,
    strategy: str = "auto",
    point: str = "point",
    cap: float | None = None,
    dist2: str = "dist2",
    index: str = "k",
) -> DataFrame:
    """Adds the squared distance to the nearest center and that center's index.

    `cap` bounds the distance from above; a point with no center below it gets index 0.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    rows = as_centers(centers)
    if strategy == "auto":
        strategy = pick_strategy(len(rows), len(rows[0]))
    df, d, k = _BUILDERS[strategy](points, rows, point)
    if cap is not None:
        d, k = F.least(d, F.lit(float(cap))), F.when(d < cap, k).otherwise(0)
    return df.select(*[f"`{c}`" for c in points.columns], d.alias(dist2), k.cast("int").alias(index))


# working columns, by a name that no table has
WORK = "__pointflow_"


def _unrolled(points: DataFrame, rows: list[list[float]], point: str):
    # each distance is its own column, so it is computed once for both results
    dims = len(rows[0])
    texts = [sqdist_text(f"`{point}`", f"{WORK}c", i, dims) for i in range(len(rows))]
    texts[0] = whole_text(f"`{point}`", dims, texts[0])
    names = [f"{WORK}d{i}" for i in range(len(rows))]
    low = f"least({', '.join(names)})" if len(rows) > 1 else names[0]
    cases = " ".join(f"WHEN {n} = {WORK}low THEN {i}" for i, n in enumerate(names))
    df = points.selectExpr(
        "*",
        f"{flat_table_text(rows)} AS {WORK}c",
        *[f"{t} AS {n}" for t, n in zip(texts, names)],
        f"{low} AS {WORK}low",
        f"CASE {cases} END AS {WORK}k",
    )
    return df, F.col(f"{WORK}low"), F.col(f"{WORK}k")


def _lambda(points: DataFrame, rows: list[list[float]], point: str):
    safe = points.selectExpr("*", whole_text(f"`{point}`", len(rows[0]), f"`{point}`") + f" AS {WORK}p")
    ranked = F.transform(
        F.expr(table_text(rows)), lambda c, i: F.struct(sqdist(F.col(f"{WORK}p"), c).alias("d"), i.alias("i"))
    )
    df = safe.withColumn(f"{WORK}best", F.array_min(ranked))
    return df, F.col(f"{WORK}best.d"), F.col(f"{WORK}best.i")


def _arrow(points: DataFrame, rows: list[list[float]], point: str):
    df = points.withColumn(f"{WORK}best", _nearest_udf(rows)(F.col(f"`{point}`").cast("array<double>")))
    return df, F.col(f"{WORK}best.dist2"), F.col(f"{WORK}best.k")


_BUILDERS = {"unrolled": _unrolled, "lambda": _lambda, "arrow": _arrow}


def nearest_index(points: DataFrame, centers: Centers, strategy: str = "auto", point: str = "point") -> DataFrame:
    """Adds `k` alone; -1 where no distance is a number below the largest double."""
    low = f"{WORK}nearest"
    best = assign_nearest(points, centers, strategy, point, dist2=low, index="k")
    found = F.col(low) < F.lit(sys.float_info.max)
    return best.withColumn("k", F.when(found, F.col("k")).otherwise(-1)).drop(low)


def nearest_dist2(
    points: DataFrame, centers: Centers, strategy: str = "auto", point: str = "point", cap: float | None = None
) -> DataFrame:
    """Adds `dist2` alone."""
    return assign_nearest(points, centers, strategy, point, cap).drop("k")
