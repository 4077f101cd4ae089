"""Lloyd rounds that skip distances by bounds carried from round to round (Hamerly 2010).

Every point keeps an upper bound of the distance to its own center and a lower
bound of that to any other. Centers that move by so much change the bounds by at
most that; while the upper bound stays below the lower one, or below half the
way from the own center to the next, the point keeps its cluster and no distance
is computed. The bounds lie in a table between the rounds.

All bounds are widened by more than the rounding of what they are made of, and a
point is skipped on a strict gap only, so the assignment is that of
`assign_nearest`, ties included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.operators.assign import BLOCK_CELLS, Centers, as_centers, matrix_of
from pointflow.operators.partials import _merge_sums
from pointflow.session import drop_folder, scratch_folder

STATE = "point array<double>, k int, upper double, lower double, skipped boolean"
# below it squares may underflow, so such bounds decide nothing
LEAST = 1e-140


def slack_of(dims: int) -> float:
    """Relative error, with room to spare, of a distance over `dims` coordinates or of one step on the bounds."""
    return (dims + 8) * 2.0**-51


def two_nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowest index of the nearest center, its squared distance, and that of the next; infinite with one center."""
    index, first, second = np.empty(len(points), np.int32), np.empty(len(points)), np.full(len(points), np.inf)
    step = max(1, BLOCK_CELLS // len(centers))
    for lo in range(0, len(points), step):
        part = points[lo : lo + step]
        total = np.zeros((len(part), len(centers)))
        for j in range(points.shape[1]):
            gap = part[:, j, None] - centers[None, :, j]
            total += gap * gap
        best = total.argmin(axis=1)
        rows = np.arange(len(part))
        index[lo : lo + step], first[lo : lo + step] = best, total[rows, best]
        if len(centers) > 1:
            total[rows, best] = np.inf
            second[lo : lo + step] = total.min(axis=1)
    return index, first, second


def _moves(old: np.ndarray, new: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per center: how far it moved at most, how far another moved at most, half the way to the next at least."""
    moved = np.sqrt(((new - old) ** 2).sum(axis=1)) * (1 + slack) + LEAST
    order = np.argsort(-moved)
    others = np.full(len(moved), moved[order[0]])
    others[order[0]] = moved[order[1]] if len(moved) > 1 else 0.0
    _, _, next2 = two_nearest(new, new)
    # of centers that coincide, one is nearest to both
    half = np.sqrt(next2) / 2 * (1 - slack)
    return moved, others, half


def _state(matrix, k, upper, lower, skipped) -> pa.RecordBatch:
    n, dims = matrix.shape
    offsets = pa.array(np.arange(0, n * dims + 1, dims, dtype=np.int32))
    cells = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).reshape(-1)))
    arrays = [cells, pa.array(k.astype(np.int32)), pa.array(upper), pa.array(lower), pa.array(skipped)]
    return pa.RecordBatch.from_arrays(arrays, names=["point", "k", "upper", "lower", "skipped"])


def _first_round(rows: list[list[float]]):
    centers = np.asarray(rows)
    slack = slack_of(centers.shape[1])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                matrix = matrix_of(batch.column("point"), centers.shape[1])
                k, first, second = two_nearest(matrix, centers)
                bounds = np.sqrt(first) * (1 + slack), np.sqrt(second) * (1 - slack)
                yield _state(matrix, k, *bounds, np.zeros(len(k), bool))

    return run


def _next_round(old_rows: list[list[float]], rows: list[list[float]]):
    centers = np.asarray(rows)
    slack = slack_of(centers.shape[1])
    moved, others, half = _moves(np.asarray(old_rows), centers, slack)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = matrix_of(batch.column("point"), centers.shape[1])
            k, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("k", "upper", "lower"))
            upper = (upper + moved[k]) * (1 + slack)
            lower = lower - others[k]
            lower -= slack * (np.abs(lower) + 2 * others[k])
            apart = np.maximum(lower, half[k])
            sure = (upper * (1 + slack) < apart * (1 - slack)) & (apart > LEAST)
            rest = np.flatnonzero(~sure)
            if len(rest):
                k[rest], first, second = two_nearest(matrix[rest], centers)
                upper[rest], lower[rest] = np.sqrt(first) * (1 + slack), np.sqrt(second) * (1 - slack)
            yield _state(matrix, k, upper, lower, sure)

    return run


def lloyd_bounded(
    points: DataFrame, centers: Centers, rounds: int, point: str = "point"
) -> tuple[list[list[float]], list[float]]:
    """The centers of `lloyd`, and for each round the share of points whose distances were skipped.

    A round reads and writes the table of points and bounds once and reads it
    again for the sums. That pays where distances cost more than the table, so
    with many centers or coordinates; else `lloyd` is the faster one.
    """
    spark = points.sparkSession
    current, old = as_centers(centers), None
    rows = points.select(F.col(f"`{point}`").cast("array<double>").alias("point"))
    shares, path = [], None
    for _ in range(rounds):
        work = _next_round(old, current) if old else _first_round(current)
        last, path = path, scratch_folder(spark, "bounds")
        rows.mapInArrow(work, STATE).write.parquet(path)
        rows = spark.read.schema(STATE).parquet(path)
        if last:
            drop_folder(spark, last)
        extra = {"n": "count(1)", "n_skipped": "count_if(skipped)"}
        found = _merge_sums(rows, ["k"], len(current[0]), extra, "point").collect()
        old, current = current, [list(c) for c in current]
        for row in found:
            current[row["k"]] = [v / row["n"] for v in row["sum"]]
        n = sum(r["n"] for r in found)
        shares.append(sum(r["n_skipped"] for r in found) / n if n else 0.0)
    if path:
        drop_folder(spark, path)
    return current, shares
