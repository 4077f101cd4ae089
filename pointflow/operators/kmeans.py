"""k-means: the library fit, its seeding alone, and plain Lloyd rounds from given centers."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.operators.assign import Centers, as_centers
from pointflow.operators.partials import cluster_group_sums

DEFAULT_SEED = 42


def kmeans_fit(
    points: DataFrame, k: int, max_iter: int, seed: int = DEFAULT_SEED, point: str = "point"
) -> list[list[float]]:
    """Centers of `pyspark.ml` k-means (k-means|| start); fewer than `k` if the points are not distinct enough."""
    vectors = points.select(array_to_vector(F.col(point).cast("array<double>")).alias("features"))
    model = KMeans(k=k, maxIter=max_iter, seed=seed).fit(vectors)
    return [[float(v) for v in c] for c in model.clusterCenters()]


def k_effective(centers: Centers) -> int:
    """Centers that a fit has found, which may be fewer than it was asked for."""
    return len(centers)


def kmeans_init(points: DataFrame, k: int, seed: int = DEFAULT_SEED, point: str = "point") -> list[list[float]]:
    """The k-means|| start without any Lloyd round."""
    return kmeans_fit(points, k, 0, seed, point)


class held:
    """Keep the columns that the rounds reread, and release them at the end.

    Used only for several rounds over a frame that is not cached already. With
    `persist=False` every round reads the source again, which suits columnar
    input larger than the executors' memory and disks.
    """

    def __init__(self, df: DataFrame, persist: bool):
        self.df = df
        self.own = persist and df.storageLevel == StorageLevel.NONE

    def __enter__(self) -> DataFrame:
        if self.own:
            self.df = self.df.persist(StorageLevel.MEMORY_AND_DISK)
        return self.df

    def __exit__(self, *exc) -> None:
        if self.own:
            self.df.unpersist()


def lloyd(
    points: DataFrame,
    centers: Centers,
    rounds: int,
    strategy: str = "auto",
    point: str = "point",
    persist: bool = False,
) -> list[list[float]]:
    """Exactly `rounds` rounds of assign and mean; a cluster without points keeps its center.

    One job per round, whose K rows come back as the next round's literals, so
    the plan does not grow.
    """
    current = as_centers(centers)
    slim = points.select(F.col(point).alias("point"), F.lit(0).alias("grp"))
    with held(slim, persist and rounds > 1) as kept:
        for _ in range(rounds):
            sums = cluster_group_sums(kept, current, strategy=strategy)
            for row in sums.select("k", "n", "sum").collect():
                current[row["k"]] = [v / row["n"] for v in row["sum"]]
    return current
