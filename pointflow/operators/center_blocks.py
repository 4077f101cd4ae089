"""Nearest of very many centers: a center table in blocks, with boxes or products and pivots in place of all differences.

The centers are a table and may outgrow what one task can hold. They are written
once, cut into blocks of bounded bytes and brought to the points some blocks at
a time; a pass keeps the best center so far with each point, so points are
neither shuffled nor paired with centers in rows.

With up to BOX_DIMS coordinates a block is halved again and again along its widest
side, down to some centers, and each part knows its bounding box. A point first
meets the centers of the nearest box, then those of all boxes that are no further
off than the best distance. A box's distance is summed as a center's is and every
step of that rounds monotonously, so it is never above that of a center inside and
nothing has to be added for rounding. Equal centers are one, of the lowest index.

With more coordinates some centers are pivots and every center belongs to the nearest
of them. A point skips all centers of a pivot that lies further off than the best
distance known and the pivot's radius together (triangle inequality). For the others
|x|^2 - 2 x.c + |c|^2 is one matrix product, whose rounding is bounded by

    (dims + 4) eps (|x| + |c|)^2,

and only centers that the bound leaves in question are computed again,
coordinate by coordinate in the order that `assign_nearest` uses. So index and
distance are the same bits as there, with ties to the lowest index.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.operators.assign import WORK, matrix_of, nearest_in_block
from pointflow.operators.metrics import GROUP_A, GROUP_B, _in, _mean, worst_of
from pointflow.session import scratch_folder

# coordinates of a block, the unit that is pivoted, and of all blocks that one pass sends to the tasks
BLOCK_BYTES = 4 << 20
PASS_BYTES = 32 << 20
# coordinates up to which blocks are trees of boxes, and centers of the smallest box
BOX_DIMS = 8
LEAF = 8
# points that are worked on at a time, and pairs of them and boxes
STEP = 2048
BOX_STEP = 1 << 14
BOX_PAIRS = 1 << 16
# squared and summed roundings; doubled for the product's own order of summation
EPS = 2 * np.finfo(float).eps
# keeps the skips of the triangle inequality on the safe side of rounding
SLACK = 1e-9
# lengths up to which no square overflows
LARGEST = 1e150
# the index of a point that has met no center yet
NONE = np.iinfo(np.int64).max


class Block(NamedTuple):
    """Centers sorted by pivot; pivot p has the rows starts[p] to starts[p + 1]."""

    ks: np.ndarray
    centers: np.ndarray
    norms: np.ndarray
    pivots: np.ndarray
    radii: np.ndarray
    starts: np.ndarray


def make_block(ks: np.ndarray, centers: np.ndarray) -> Block:
    """Pivots are centers at equal steps of the index, about as many as the square root of all."""
    with np.errstate(over="ignore", invalid="ignore"):
        number = max(1, round(len(ks) ** 0.5))
        pivots = centers[np.linspace(0, len(ks) - 1, number).round().astype(int)]
        dist2, own = nearest_in_block(centers, pivots)
        order = np.lexsort((ks, own))
        radii = np.zeros(number)
        np.maximum.at(radii, own, np.sqrt(dist2))
        starts = np.searchsorted(own[order], np.arange(number + 1))
        norms = np.sqrt((centers * centers).sum(axis=1))
    return Block(ks[order], centers[order], norms[order], pivots, radii, starts)


class Boxes(NamedTuple):
    """Centers sorted by box, the coordinates first; node i has the halves 2i and 2i + 1, and leaf i is node leaves + i."""

    ks: np.ndarray
    centers: np.ndarray
    largest: float
    low: np.ndarray
    high: np.ndarray
    starts: np.ndarray
    merged: int


def make_boxes(ks: np.ndarray, centers: np.ndarray) -> Boxes:
    order = np.lexsort((ks, *centers.T))
    fresh = np.ones(len(ks), dtype=bool)
    fresh[1:] = (centers[order[1:]] != centers[order[:-1]]).any(axis=1)
    ks, centers, merged = ks[order[fresh]], centers[order[fresh]], len(ks) - int(fresh.sum())
    levels = max(0, int(np.ceil(np.log2(len(ks) / LEAF))))
    order = np.arange(len(ks))
    for level in range(levels):
        halves = (len(ks) * np.arange((2 << level) + 1) >> (level + 1)).tolist()
        for a, m, b in zip(halves[::2], halves[1::2], halves[2::2]):
            own = order[a:b]
            part = centers[own]
            side = (part.max(axis=0) / 2 - part.min(axis=0) / 2).argmax()
            order[a:b] = own[np.argpartition(part[:, side], m - a)]
    starts = len(ks) * np.arange((1 << levels) + 1) >> levels
    ks, centers = ks[order], np.ascontiguousarray(centers[order].T)
    low, high = (f.reduceat(centers, starts[:-1], axis=1) for f in (np.minimum, np.maximum))
    lows, highs = [low], [high]
    for _ in range(levels):
        lows.append(np.minimum(lows[-1][:, ::2], lows[-1][:, 1::2]))
        highs.append(np.maximum(highs[-1][:, ::2], highs[-1][:, 1::2]))
    # there is no node 0
    low, high = (np.concatenate([x[-1], *x[::-1]], axis=1) for x in (lows, highs))
    with np.errstate(over="ignore"):
        largest = float(np.sqrt((centers * centers).sum(axis=0)).max())
    return Boxes(ks, centers, largest, low, high, starts, merged)


def exact(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, summed in the order of the coordinates."""
    total = np.zeros(len(points))
    for j in range(points.shape[1]):
        gap = points[:, j] - centers[:, j]
        total += gap * gap
    return total


def _better(best: np.ndarray, index: np.ndarray, i: np.ndarray, dist2: np.ndarray, k: np.ndarray) -> None:
    """Take candidates of the points `i` that are nearer, or as near and of a lower index."""
    order = np.lexsort((k, dist2, i))
    i, dist2, k = i[order], dist2[order], k[order]
    first = np.flatnonzero(np.diff(i, prepend=-1))
    i, dist2, k = i[first], dist2[first], k[first]
    take = (dist2 < best[i]) | ((dist2 == best[i]) & (k < index[i]))
    best[i[take]], index[i[take]] = dist2[take], k[take]


def _among(points, norms, block: Block, cell: int, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
    """Compare the points `rows` with the centers of one pivot."""
    own = slice(block.starts[cell], block.starts[cell + 1])
    centers = block.centers[own]
    if not len(rows) or not len(centers):
        return
    far = norms[rows, None] + block.norms[None, own]
    near = (norms[rows] ** 2)[:, None] - 2 * (points[rows] @ centers.T) + (block.norms[own] ** 2)[None, :]
    error = (points.shape[1] + 4) * EPS * far * far
    bound = np.minimum((near + error).min(axis=1), best[rows])
    i, j = np.nonzero(near - error <= bound[:, None])
    _better(best, index, rows[i], exact(points[rows[i]], centers[j]), block.ks[own][j])


def _to_box(points: np.ndarray, tree: Boxes, rows, nodes: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes; `points` has the coordinates first."""
    total = np.zeros(len(nodes))
    for x, low, high in zip(points, tree.low, tree.high):
        x = x[rows]
        gap = np.maximum(np.maximum(low[nodes] - x, x - high[nodes]), 0)
        total += gap * gap
    return total


def _in_leaves(points: np.ndarray, tree: Boxes, rows: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest squared distance of each point to a leaf's centers, and their lowest index."""
    start, stop = tree.starts[leaves], tree.starts[leaves + 1]
    # leaves differ by one in size; the last center of a smaller one counts twice
    at = np.minimum(start[:, None] + np.arange((stop - start).max()), stop[:, None] - 1)
    total = np.zeros(at.shape)
    for x, c in zip(points, tree.centers):
        gap = x[rows][:, None] - c[at]
        total += gap * gap
    dist2 = total.min(axis=1)
    return dist2, np.where(total == dist2[:, None], tree.ks[at], NONE).min(axis=1)


def _improve_by_boxes(points: np.ndarray, tree: Boxes, best: np.ndarray, index: np.ndarray) -> int:
    """`improve` for points whose squares do not overflow; works on `best` and `index` and returns the distances computed."""
    n, leaves = len(points), len(tree.starts) - 1
    points = np.ascontiguousarray(points.T)
    every = np.arange(n)
    node = np.ones(n, dtype=np.int64)
    while len(node) and node[0] < leaves:
        left = 2 * node
        node = left + (_to_box(points, tree, every, left) > _to_box(points, tree, every, left + 1))
    home = node - leaves
    dist2, k = _in_leaves(points, tree, every, home)
    take = (dist2 < best) | ((dist2 == best) & (k < index))
    best[take], index[take] = dist2[take], k[take]
    computed = n * -(-len(tree.ks) // leaves)
    waiting = [(every[a : a + BOX_PAIRS], np.ones(len(every[a : a + BOX_PAIRS]), dtype=np.int64)) for a in range(0, n, BOX_PAIRS)]
    while waiting:
        rows, node = waiting.pop()
        near = _to_box(points, tree, rows, node) <= best[rows]
        rows, node = rows[near], node[near]
        if not len(rows):
            continue
        if node[0] >= leaves:
            other = node - leaves != home[rows]
            rows, node = rows[other], node[other] - leaves
            if len(rows):
                _better(best, index, rows, *_in_leaves(points, tree, rows, node))
                computed += len(rows) * -(-len(tree.ks) // leaves)
            continue
        # all pairs of a piece are of one level
        rows, node = np.repeat(rows, 2), (2 * node[:, None] + np.arange(2)).ravel()
        waiting += [(rows[a : a + BOX_PAIRS], node[a : a + BOX_PAIRS]) for a in range(0, len(rows), BOX_PAIRS)]
    return computed


def _improve_boxes(points: np.ndarray, tree: Boxes, best: np.ndarray, index: np.ndarray) -> int:
    with np.errstate(over="ignore", invalid="ignore"):
        plain = np.sqrt((points * points).sum(axis=1)) < (LARGEST if tree.largest < LARGEST else 0)
    odd, rows = np.flatnonzero(~plain), np.flatnonzero(plain)
    if len(odd):
        by_index = np.argsort(tree.ks)
        _in_full(points, tree.ks[by_index], tree.centers.T[by_index], odd, best, index)
    own, which = best[rows], index[rows]
    computed = _improve_by_boxes(points[rows], tree, own, which) if len(rows) else 0
    best[rows], index[rows] = own, which
    return max(0, len(rows) * (len(tree.ks) + tree.merged) - computed)


def _in_full(points, ks: np.ndarray, centers: np.ndarray, odd: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
    """Compare the points `odd`, whose squares may overflow, with all centers, which come by index."""
    with np.errstate(over="ignore", invalid="ignore"):
        dist2, at = nearest_in_block(points[odd], centers)
    k = ks[at]
    # no distance of a point with a NaN is smaller than another: the lowest index stands
    take = (dist2 < best[odd]) | ((dist2 == best[odd]) | np.isnan(dist2)) & (k < index[odd])
    best[odd[take]], index[odd[take]] = dist2[take], k[take]


def improve(points: np.ndarray, blocks: list[Block | Boxes], best: np.ndarray, index: np.ndarray) -> int:
    """Bring `best` and `index` of the points up to date with the blocks; returns the distances that were skipped."""
    skipped = 0
    with np.errstate(over="ignore", invalid="ignore"):
        norms = np.sqrt((points * points).sum(axis=1))
    for block in blocks:
        if isinstance(block, Boxes):
            skipped += _improve_boxes(points, block, best, index)
            continue
        # where squares overflow no bound holds; such points are compared in full
        plain = (norms < LARGEST) & (block.norms < LARGEST).all()
        odd = np.flatnonzero(~plain)
        if len(odd):
            by_index = np.argsort(block.ks)
            _in_full(points, block.ks[by_index], block.centers[by_index], odd, best, index)
        rows = np.flatnonzero(plain)
        if not len(rows):
            continue
        to_pivot = np.sqrt(np.maximum(0, (norms[rows] ** 2)[:, None] - 2 * (points[rows] @ block.pivots.T) + (block.pivots**2).sum(axis=1)))
        # what the product may be wrong by, taken off the distance to a pivot
        wrong = np.sqrt((points.shape[1] + 4) * EPS) * (norms[rows].max() + block.norms.max()) + SLACK
        home = to_pivot.argmin(axis=1)
        for cell in np.unique(home):
            _among(points, norms, block, cell, rows[home == cell], best, index)
        for cell in range(len(block.pivots)):
            least = to_pivot[:, cell] - wrong - block.radii[cell] * (1 + SLACK)
            there = (least <= np.sqrt(best[rows]) * (1 + SLACK)) & (home != cell)
            skipped += int((~there & (home != cell)).sum()) * int(block.starts[cell + 1] - block.starts[cell])
            _among(points, norms, block, cell, rows[there], best, index)
    return skipped


def _pass_udf(shared, dims: int):
    @F.arrow_udf("struct<dist2: double, k: bigint, skipped: bigint>")
    def run(point: pa.Array, dist2: pa.Array, k: pa.Array, skipped: pa.Array) -> pa.Array:
        points = matrix_of(point, dims)
        best = dist2.fill_null(np.inf).to_numpy(zero_copy_only=False).copy()
        index = k.fill_null(int(NONE)).to_numpy(zero_copy_only=False).copy()
        left_out = skipped.to_numpy(zero_copy_only=False).copy()
        step = BOX_STEP if dims <= BOX_DIMS else STEP
        for at in range(0, len(points), step):
            part = slice(at, at + step)
            if len(points[part]):
                left_out[at] += improve(points[part], shared.value, best[part], index[part])
        return pa.StructArray.from_arrays([pa.array(best), pa.array(index), pa.array(left_out)], names=["dist2", "k", "skipped"])

    return run


def _center_blocks(centers: DataFrame, k: str, center: str, block_bytes: int | None, pass_bytes: int, folder: str) -> tuple[DataFrame, int, int, int]:
    """The written center table `k, center, block`, its width, number of blocks and blocks of a pass; refuses odd centers."""
    rows = centers.select(F.col(k).cast("bigint").alias("k"), F.col(center).cast("array<double>").alias("center"))
    fine = F.coalesce(F.forall("center", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(False)) & F.col("k").isNotNull()
    facts = rows.agg(
        F.count("*").alias("n"),
        F.count_distinct("k").alias("ks"),
        F.count_if(~fine).alias("odd"),
        F.min(F.size("center")).alias("low"),
        F.max(F.size("center")).alias("high"),
    ).first()
    if not facts["n"] or facts["high"] < 1:
        raise ValueError("a center set needs at least one center with one coordinate")
    if facts["odd"]:
        raise ValueError("centers must be finite and have an index")
    if facts["low"] != facts["high"]:
        raise ValueError("centers differ in their number of coordinates")
    if facts["ks"] != facts["n"]:
        raise ValueError("two centers have the same index")
    # one large tree takes fewer steps than several small ones
    block_bytes = block_bytes or (pass_bytes if facts["high"] <= BOX_DIMS else BLOCK_BYTES)
    blocks = -(-facts["n"] * facts["high"] * 8 // block_bytes)
    # ranges of neighbouring indexes make uneven blocks, a hash does not
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int"))
    dealt.repartition("block").sortWithinPartitions("block", "k").write.parquet(folder)
    return centers.sparkSession.read.schema(dealt.schema).parquet(folder), facts["high"], blocks, max(1, pass_bytes // block_bytes)


def assign_nearest_blocks(
    points: DataFrame,
    centers: DataFrame,
    point: str = "point",
    k: str = "k",
    center: str = "center",
    dist2: str = "dist2",
    index: str = "k",
    skipped: str | None = None,
    block_bytes: int | None = None,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """`assign_nearest` for a table of centers of any size: adds the squared distance and the center's index.

    `skipped` names one more column, whose sum is the number of distances that were not computed.
    Points are refused as there. With more than one pass the points are written in between.
    """
    spark = points.sparkSession
    folder = scratch_folder(spark, "centers")
    table, dims, blocks, step = _center_blocks(centers, k, center, block_bytes, pass_bytes, f"{folder}/table")
    columns = [f"`{c}`" for c in points.columns if c not in (dist2, index, skipped)]
    state = f"{WORK}best"
    typed = F.col(f"`{point}`").cast("array<double>")
    none = "named_struct('dist2', CAST(NULL AS DOUBLE), 'k', CAST(NULL AS BIGINT), 'skipped', 0L)"
    df = points.selectExpr(*columns, f"{none} AS {state}")
    for first in range(0, blocks, step):
        if first:
            path = f"{folder}/pass-{first}"
            df.write.parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
        made = []
        for number in range(first, min(blocks, first + step)):
            # one block of bounded bytes at a time comes to the driver
            found = table.where(F.col("block") == number).select("k", "center").toArrow().combine_chunks()
            if found.num_rows:
                matrix = found.column("center").combine_chunks().flatten().to_numpy().reshape(-1, dims)
                make = make_boxes if dims <= BOX_DIMS else make_block
                made.append(make(found.column("k").to_numpy(), matrix))
        run = _pass_udf(spark.sparkContext.broadcast(made), dims)
        df = df.withColumn(state, run(typed, f"{state}.dist2", f"{state}.k", f"{state}.skipped"))
    extra = [F.col(f"{state}.skipped").alias(skipped)] if skipped else []
    return df.select(*columns, F.col(f"{state}.dist2").alias(dist2), F.col(f"{state}.k").alias(index), *extra)


def cluster_report_blocks(points: DataFrame, centers: DataFrame, **options) -> DataFrame:
    """`metrics.cluster_report` for a table `(k, center)` of any size: one row per center.

    Clusters are counted by a shuffle with a map-side part; the totals of the whole set come from those rows.
    """
    assigned = assign_nearest_blocks(points, centers, **options)
    sums = assigned.groupBy("k").agg(
        F.count_if(_in(GROUP_A)).alias("n_a_k"),
        F.count_if(_in(GROUP_B)).alias("n_b_k"),
        F.coalesce(F.sum(F.when(_in(GROUP_A), F.col("dist2"))), F.lit(0.0)).alias("ss_a"),
        F.coalesce(F.sum(F.when(_in(GROUP_B), F.col("dist2"))), F.lit(0.0)).alias("ss_b"),
    )
    spark = points.sparkSession
    path = scratch_folder(spark, "report")
    sums.write.parquet(path)
    sums = spark.read.schema(sums.schema).parquet(path)
    both = F.struct(*[F.coalesce(F.sum(s), F.lit(0)).alias(t) for s, t in (("n_a_k", "n_a"), ("n_b_k", "n_b"))], F.coalesce(F.sum("ss_a"), F.lit(0.0)).alias("ss_a"), F.coalesce(F.sum("ss_b"), F.lit(0.0)).alias("ss_b"))
    total = sums.agg(both).scalar()
    rows = centers.select(F.col("k").cast("bigint").alias("k"), "center").join(sums.drop("ss_a", "ss_b"), "k", "left")
    judged = rows.withColumn("t", total).select(
        "k", "center", F.coalesce("n_a_k", F.lit(0)).alias("n_a_k"), F.coalesce("n_b_k", F.lit(0)).alias("n_b_k"), (F.col("t.n_a") + F.col("t.n_b")).alias("n"), "t.n_a", "t.n_b", "t.ss_a", "t.ss_b"
    )
    judged = judged.select(
        *judged.columns[:-2],
        F.when(F.col("n") > 0, (F.col("ss_a") + F.col("ss_b")) / F.col("n")).alias("delta"),
        _mean("ss_a", "n_a").alias("phi_a"),
        _mean("ss_b", "n_b").alias("phi_b"),
    )
    return judged.withColumn("phi", worst_of(F.col("phi_a"), F.col("phi_b")))
