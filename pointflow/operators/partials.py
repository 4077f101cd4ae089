"""Sums, means and scatter of point sets per (cluster, group).

All of it is one aggregation with a map-side part: a task sends at most two
rows per cluster (and per value of `by`), however the points are spread, so a
cluster that holds a third of the data costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.operators.assign import (
    Centers,
    as_centers,
    assign_nearest,
    matrix_of,
    nearest_in_block,
    pick_strategy,
    whole_text,
)

# partial rows of a set are joined within so many slots first, so that no list holds those of all tasks
MERGE_SLOTS = 64
# widths up to which one sum column per coordinate is used; beyond it the coordinates become rows
WIDE_DIMS = 100
GROUPS = 2


def group_text(grp: str) -> str:
    """The group of a row, or an error if it is neither 0 nor 1."""
    return f"if(`{grp}` IN (0, 1), CAST(`{grp}` AS INT), raise_error('grp must be 0 or 1'))"


def point_dims(points: DataFrame, point: str = "point") -> int:
    """Width of the points, read from one row."""
    row = points.select(F.size(point)).first()
    if row is None:
        raise ValueError("no points: state the number of coordinates")
    return row[0]


def _merge_sums(
    df: DataFrame, keys: Sequence[str], dims: int, extra: dict[str, str], cells: str = "sum", moments: bool = False
) -> DataFrame:
    """Group by `keys`: the SQL aggregates in `extra`, and the element-wise sum of the array column `cells`.

    With `moments` also `m2`, the sum of squared distances to the set's own mean,
    from Spark's variances, whose partial results carry a mean of their own.
    """
    scalars = [F.expr(f"{text} AS {name}") for name, text in extra.items()]
    if dims <= WIDE_DIMS:
        totals = [F.expr(f"sum({cells}[{j}]) AS _s{j}") for j in range(dims)]
        packed = ", ".join(f"_s{j}" for j in range(dims))
        if moments:
            spread = " + ".join(f"var_pop({cells}[{j}])" for j in range(dims))
            scalars.append(F.expr(f"count(1) * ({spread}) AS m2"))
        columns = [*keys, *extra, *["m2"] * moments]
        return df.groupBy(*keys).agg(*scalars, *totals).selectExpr(*columns, f"array({packed}) AS sum")
    # one row per coordinate, of which every one carries the scalars to its own group
    exploded = df.select("*", F.posexplode(cells).alias("_j", "_v"))
    spread = [F.expr("count(1) * var_pop(_v) AS m2")] if moments else []
    per_cell = exploded.groupBy(*keys, "_j").agg(*scalars, *spread, F.sum("_v").alias("_v"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_j", "_v"))), lambda e: e["_v"]).alias("sum")
    whole = [F.sum("m2").alias("m2")] if moments else []
    return per_cell.groupBy(*keys).agg(*[F.max(n).alias(n) for n in extra], *whole, ordered)


# two sets as one: counts and sums add up, and the gap between the means adds to the squares around them
_JOINED = """named_struct(
    'n', a.n + b.n,
    'sum', zip_with(a.sum, b.sum, (u, v) -> u + v),
    'ss', a.ss + b.ss,
    'm2', a.m2 + b.m2 + CAST(a.n AS DOUBLE) * b.n / (a.n + b.n) * aggregate(
        zip_with(a.sum, b.sum, (u, v) -> (v / b.n - u / a.n) * (v / b.n - u / a.n)), 0D, (u, v) -> u + v))"""


def _merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Joins rows `n, sum, ss, m2` of the same set pairwise, within slots of tasks and then over the slots."""
    slotted = parts.withColumn("_slot", F.pmod(F.spark_partition_id(), F.lit(MERGE_SLOTS)))
    joined = f"aggregate(slice(cells, 2, size(cells)), cells[0], (a, b) -> {_JOINED}) AS one"
    for names in ([*keys, "_slot"], list(keys)):
        lists = slotted.groupBy(*names).agg(F.collect_list(F.struct("n", "sum", "ss", "m2")).alias("cells"))
        slotted = lists.selectExpr(*names, joined).select(*names, "one.*")
    return slotted


def cluster_group_sums(
    points: DataFrame,
    centers: Centers,
    by: Sequence[str] = (),
    strategy: str = "auto",
    point: str = "point",
    grp: str = "grp",
    moments: bool = False,
) -> DataFrame:
    """`(by..., k, grp, n, sum, ss)` for the non-empty sets; `ss` is the sum of squared distances to the old center.

    With `moments` there is also `m2`, the sum of squared distances to the set's
    own mean. It comes from means and squares around them that are joined
    pairwise, so it keeps its digits however far the points are from the centers.
    Small center sets stay in generated code. For others each task assigns and
    adds up its Arrow batches in one pass and returns only the sums.
    """
    rows = as_centers(centers)
    dims = len(rows[0])
    if strategy == "auto":
        strategy = pick_strategy(len(rows), dims)
    keys = [*by, "k", "grp"]
    points = points.selectExpr(*by, f"`{point}` AS point", f"{group_text(grp)} AS grp")
    if strategy != "arrow":
        assigned = assign_nearest(points, rows, strategy)
        return _merge_sums(assigned, keys, dims, {"n": "count(1)", "ss": "sum(dist2)"}, "point", moments)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in points.select(*by).schema.fields]
    schema = ", ".join([*fields, "k int, grp int, n bigint, `sum` array<double>, ss double, m2 double"])
    partial = points.withColumn("point", F.col("point").cast("array<double>")).mapInArrow(
        _batch_sums(rows, list(by), moments), schema
    )
    if moments:
        return _merge_moments(partial, keys)
    return _merge_sums(partial, keys, dims, {"n": "sum(n)", "ss": "sum(ss)"})


def add_up(matrix: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
    """Row sums of `matrix` per code."""
    out = np.empty((size, matrix.shape[1]))
    for j in range(matrix.shape[1]):
        out[:, j] = np.bincount(codes, weights=matrix[:, j], minlength=size)
    return out


def squares_around_means(matrix: np.ndarray, codes: np.ndarray, n: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Per code the sum of squared distances of its rows to their mean."""
    means = sums / np.maximum(n, 1)[:, None]
    gaps = matrix - means[codes]
    return np.bincount(codes, weights=(gaps * gaps).sum(axis=1), minlength=len(n))


def _batch_sums(rows: list[list[float]], by: list[str], moments: bool):
    table = np.asarray(rows)
    k, dims = table.shape

    def pack(by_columns, cell, n, sums, ss, m2):
        flat = pa.array(sums.reshape(-1))
        offsets = pa.array(np.arange(0, len(sums) * dims + 1, dims, dtype=np.int32))
        arrays = [
            *by_columns,
            pa.array((cell // GROUPS).astype(np.int32)),
            pa.array((cell % GROUPS).astype(np.int32)),
            pa.array(n.astype(np.int64)),
            pa.ListArray.from_arrays(offsets, flat),
            pa.array(ss),
            pa.array(m2),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[*by, "k", "grp", "n", "sum", "ss", "m2"])

    def measure(batch):
        matrix = matrix_of(batch.column("point"), dims)
        dist2, index = nearest_in_block(matrix, table)
        grp = batch.column("grp").to_numpy(zero_copy_only=False)
        if not np.isin(grp, range(GROUPS)).all():
            raise ValueError("grp must be 0 or 1")
        return matrix, dist2, index * GROUPS + grp.astype(np.int64)

    def whole(batches):
        n, ss, sums, m2 = np.zeros(k * GROUPS), np.zeros(k * GROUPS), np.zeros((k * GROUPS, dims)), np.zeros(k * GROUPS)
        for batch in batches:
            if batch.num_rows:
                matrix, dist2, cell = measure(batch)
                here, added = np.bincount(cell, minlength=len(n)), add_up(matrix, cell, len(n))
                if moments:
                    gaps = added / np.maximum(here, 1)[:, None] - sums / np.maximum(n, 1)[:, None]
                    between = n * here / np.maximum(n + here, 1) * (gaps * gaps).sum(axis=1)
                    m2 += squares_around_means(matrix, cell, here, added) + between
                n += here
                ss += np.bincount(cell, weights=dist2, minlength=len(n))
                sums += added
        used = np.flatnonzero(n)
        yield pack([], used, n[used], sums[used], ss[used], m2[used])

    def keyed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix, dist2, cell = measure(batch)
            frame = pa.Table.from_batches([batch.select(by)]).to_pandas()
            segment = frame.groupby(by, dropna=False, sort=False).ngroup().to_numpy()
            _, first, codes = np.unique(segment * (k * GROUPS) + cell, return_index=True, return_inverse=True)
            size = len(first)
            n, sums = np.bincount(codes, minlength=size), add_up(matrix, codes, size)
            yield pack(
                [batch.column(c).take(pa.array(first)) for c in by],
                cell[first],
                n,
                sums,
                np.bincount(codes, weights=dist2, minlength=size),
                squares_around_means(matrix, codes, n, sums) if moments else np.zeros(size),
            )

    return keyed if by else whole


def cluster_group_means(sums: DataFrame) -> DataFrame:
    """`cluster_group_sums` with `mean` in place of `sum`."""
    mean = F.transform("sum", lambda v: v / F.col("n")).alias("mean")
    return sums.where("n > 0").select(*[c for c in sums.columns if c != "sum"], mean)


def mean_vector(points: DataFrame, dims: int | None = None, by: Sequence[str] = (), point: str = "point") -> DataFrame:
    """`(by..., n, mean)`; without `by` an empty input gives one row with n = 0 and a NULL mean.

    A missing point or coordinate and a point of another width are refused at
    every width. Wide points are added up by Arrow batch before anything is sent.
    """
    dims = dims or point_dims(points, point)
    typed = points.select(*by, F.col(point).cast("array<double>").alias("point"))
    if dims <= WIDE_DIMS:
        typed = typed.selectExpr(*by, whole_text("point", dims, "point") + " AS point")
        total = _merge_sums(typed, list(by), dims, {"n": "count(1)"}, "point")
    else:
        # all points belong to the one center at the origin
        alone = typed.withColumn("grp", F.lit(0))
        total = cluster_group_sums(alone, [[0.0] * dims], by, "arrow")
        if not by:
            total = total.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.first("sum").alias("sum"))
    return total.selectExpr(*by, "n", "if(n > 0, transform(sum, s -> s / n), NULL) AS mean")


def scatter_text(center: str) -> str:
    """Sum of squared distances to the own mean, from `ss`, that of the distances to `center`.

    sum |x-m|^2 = sum |x-c|^2 - n |m-c|^2 needs no second pass over the points, but
    loses digits where the means are far from the centers; `m2` does not.
    """
    gap = f"zip_with(sum, {center}, (s, c) -> (s / n - c) * (s / n - c))"
    return f"greatest(ss - n * aggregate({gap}, 0D, (u, v) -> u + v), 0D)"
