"""Lloyd rounds of many models at once: every segment of the points has centers of its own.

Models are rows of a table `(by..., k, center)` and stay one: a round is one job
for all segments, writes the new table to the shared scratch folder and reads it
again, so the plan does not grow and no center comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.functions.vectors import sqdist
from pointflow.functions.draws import salt
from pointflow.operators.assign import MAX_CENTER_BYTES, UNROLLED_CELLS, WORK, whole_text
from pointflow.operators.partials import _merge_sums
from pointflow.session import drop_folder, scratch_folder

# tasks that share the points of one segment where the models are too large to send to every task
SPREAD = 16


def _packed(centers: DataFrame, by: Sequence[str]) -> DataFrame:
    """`(by..., cells)`: a model's centers in one row, in order of `k`."""
    cell = F.struct(F.col("k").cast("int").alias("k"), F.col("center").cast("array<double>").alias("center"))
    return centers.groupBy(*by).agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def _measured(packed: DataFrame) -> tuple[int, int]:
    """Width and bytes of all models, in one pass; refuses models that no center set could be."""
    facts = packed.selectExpr(
        "size(cells) AS n",
        "size(cells) - size(array_distinct(cells.k)) AS twice",
        "array_min(transform(cells, c -> size(c.center))) AS low",
        "array_max(transform(cells, c -> size(c.center))) AS high",
        "exists(cells, c -> c.k IS NULL OR c.center IS NULL"
        " OR exists(c.center, v -> v IS NULL OR isnan(v) OR abs(v) = double('inf'))) AS bad",
    ).agg(*[F.expr(t) for t in ("min(low)", "max(high)", "sum(n * high * 8)", "max(n * high * 8)", "max(twice)", "max(bad)")])
    low, high, total, largest, twice, bad = facts.first()
    if not high:
        raise ValueError("a center set needs at least one center with one coordinate")
    if bad or low != high:
        raise ValueError("centers must have finite coordinates, equally many, and an index")
    if twice:
        raise ValueError("two centers of a segment have the same index")
    if largest > MAX_CENTER_BYTES:
        raise ValueError("center set of a segment too large for a row")
    return high, total


def assign_by(
    points: DataFrame,
    centers: DataFrame,
    by: Sequence[str],
    point: str = "point",
    broadcast_bytes: int = MAX_CENTER_BYTES,
    shape: tuple[int, int] | None = None,
) -> DataFrame:
    """Adds `dist2` and `k` of the nearest center of the point's own segment; ties go to the lowest index.

    Models of up to `broadcast_bytes` together are sent to every task. Beyond it
    points meet their model in a shuffle, each segment spread over SPREAD tasks,
    so that one with a third of all points does not lie in one task. NULL is a
    segment like others. A segment without centers is refused, and so are points
    that `assign_nearest` refuses.
    """
    packed = _packed(centers, by)
    dims, total = shape or _measured(packed)
    keys = [f"{WORK}by{i}" for i in range(len(by))]
    models = packed.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)], F.col("cells").alias(f"{WORK}cells"))
    rows = points.select("*", F.expr(whole_text(f"`{point}`", dims, f"`{point}`")).cast("array<double>").alias(f"{WORK}p"))
    on = [F.col(f"`{c}`").eqNullSafe(F.col(k)) for c, k in zip(by, keys)]
    if total <= broadcast_bytes:
        models = F.broadcast(models)
    else:
        rows = rows.withColumn(f"{WORK}salt", salt(SPREAD, f"{WORK}p"))
        models = models.withColumn(f"{WORK}part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        on.append(F.col(f"{WORK}salt") == F.col(f"{WORK}part"))
    p = F.col(f"{WORK}p")

    def ranked(cell):
        if dims > UNROLLED_CELLS:
            return F.struct(sqdist(p, cell["center"]).alias("d"), cell["k"].alias("k"))
        gaps = [p[j] - cell["center"][j] for j in range(dims)]
        d = gaps[0] * gaps[0]
        for gap in gaps[1:]:
            d = d + gap * gap
        return F.struct(d.alias("d"), cell["k"].alias("k"))

    cells = F.col(f"{WORK}cells")
    known = F.when(cells.isNull(), F.raise_error(F.lit("a segment has no centers"))).otherwise(cells)
    near = rows.join(models, on, "left").withColumn(f"{WORK}best", F.array_min(F.transform(known, ranked)))
    best = F.col(f"{WORK}best")
    return near.select(*[f"`{c}`" for c in points.columns], best["d"].alias("dist2"), best["k"].alias("k"))


def lloyd_by(
    points: DataFrame,
    centers: DataFrame,
    by: Sequence[str],
    rounds: int,
    point: str = "point",
    broadcast_bytes: int = MAX_CENTER_BYTES,
) -> DataFrame:
    """`(by..., k, center)` after exactly `rounds` rounds of assign and mean in every segment.

    A cluster without points keeps its center, and so does a segment without
    points. The points are shuffled as sums only: a task sends a row per cluster.
    """
    spark = points.sparkSession
    shape = _measured(_packed(centers, by))
    slim = points.select(*by, F.col(f"`{point}`").alias("point"))
    current = centers.select(*by, F.col("k").cast("int").alias("k"), F.col("center").cast("array<double>").alias("center"))
    path = None
    for _ in range(rounds):
        near = assign_by(slim, current, by, "point", broadcast_bytes, shape)
        sums = _merge_sums(near, [*by, "k"], shape[0], {"n": "count(1)"}, "point")
        means = sums.select(*by, "k", F.transform("sum", lambda v: v / F.col("n")).alias("mean"))
        # the old center and the mean of a cluster meet in one group, which takes NULL segments as any others
        both = current.withColumn("mean", F.lit(None).cast("array<double>")).unionByName(means, allowMissingColumns=True)
        after = both.groupBy(*by, "k").agg(F.coalesce(F.max("mean"), F.max("center")).alias("center"))
        last, path = path, scratch_folder(spark, "models")
        after.write.parquet(path)
        current = spark.read.parquet(path)
        if last:
            drop_folder(spark, last)
    return current
