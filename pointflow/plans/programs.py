"""Whole programs over a file or a stream: what a user runs from end to end.

Each returns DataFrames; `python -m pointflow` shows them. `parts` is the
number of partitions to spread the input over first, and None leaves the
splits of the scan alone, which is right for large inputs.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointflow.operators import fair, kmeans, metrics, words
from pointflow.session import scratch_folder
from pointflow.sources import blobs, items, points
from pointflow.streaming import distinct


def _input(spark: SparkSession, path: str, parts: int | None) -> DataFrame:
    lines = points.read_lines(spark, path)
    return points.load_parts(lines, parts) if parts else lines


def _width(lines: DataFrame, dims: int | None) -> int:
    """The stated width, or that of the first point; lines of another width are bad."""
    width = dims or points.first_width(lines)
    if not width:
        raise ValueError("the input has no point")
    return width


def clusters(
    spark: SparkSession, path: str, k: int, rounds: int, parts: int | None = None, dims: int | None = None, seed: int = 42
) -> dict[str, DataFrame]:
    """Fit k-means and judge it: the `fit`, `counts` of the groups, and a `report` with a row per center.

    `fit` has the k that was asked for and `k_effective`, which is smaller where
    the points are not distinct enough. The points are spread and kept while the
    centers are fitted; the frames that come back read the file again as it is,
    so nothing stays cached and no text is shuffled for them.
    """
    lines = points.read_lines(spark, path)
    width = _width(lines, dims)
    kept = points.parse_points(_input(spark, path, parts), width).select("point", "grp").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centers = kmeans.kmeans_fit(kept, k, rounds, seed)
    finally:
        kept.unpersist()
    return {
        "fit": spark.createDataFrame([(k, kmeans.k_effective(centers))], "k int, k_effective int"),
        "counts": points.group_counts(lines),
        "report": metrics.cluster_report(points.parse_points(lines, width), centers),
    }


def fairness(
    spark: SparkSession,
    path: str,
    k: int,
    rounds: int,
    parts: int | None = None,
    dims: int | None = None,
    seed: int = 42,
    selection: str = "cluster_means",
) -> dict[str, DataFrame]:
    """Standard against fair centers: `counts` of the groups, `centers` of both, and a `report` with a row for each."""
    lines = points.read_lines(spark, path)
    width = _width(lines, dims)
    kept = points.parse_points(_input(spark, path, parts), width).select("point", "grp").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = {
            "standard": kmeans.kmeans_fit(kept, k, rounds, seed),
            "fair": fair.fair_lloyd(kept, None, rounds, selection, k=k, seed=seed),
        }
    finally:
        kept.unpersist()
    rows = [(name, i, center) for name, model in models.items() for i, center in enumerate(model)]
    return {
        "counts": points.group_counts(lines),
        "centers": spark.createDataFrame(rows, "model string, k int, center array<double>"),
        "report": metrics.compare_centers(points.parse_points(lines, width), models),
    }


def word_report(spark: SparkSession, path: str, parts: int | None = None) -> dict[str, DataFrame]:
    """`counts` of the words of a file whose lines are documents, and their `summary`."""
    lines = _input(spark, path, parts)
    return {"counts": words.word_count(lines), "summary": words.wordcount_summary(lines)}


def distinct_report(
    spark: SparkSession,
    path: str,
    threshold: int,
    interval: str | None = None,
    files_per_batch: int | None = 1,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """The `sizes` of the batches of a folder of number files up to a threshold, with their times, and their `summary`.

    With `folder` the tables are kept there, and a program that is started again goes on from them.
    """
    stream = items.parse_items(items.stream_lines(spark, path, files_per_batch))
    tables = distinct.run_batches(stream, folder or scratch_folder(spark, "distinct"), threshold, interval=interval)
    return {"sizes": tables.log(), "summary": tables.summary()}


def generate(spark: SparkSession, path: str, n: int, k: int, seed: int = blobs.DEFAULT_SEED, shuffle: bool = True) -> None:
    """Write `x,y,label` lines of generated blobs, in random order by default."""
    rows = blobs.gen_blobs(spark, n, k, seed, shuffle)
    points.write_points(rows.select(F.array("x", "y").alias("point"), "label"), path)
