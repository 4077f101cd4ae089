"""Objectives and group counts of a center set, all from one pass over the points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointflow.functions.vectors import table_text
from pointflow.operators.assign import Centers, as_centers, assign_nearest
from pointflow.operators.partials import group_text

GROUP_A, GROUP_B = 0, 1


def _in(group: int, grp: str = "grp") -> Column:
    """Whether a row is of a group; a row of neither is refused, so that all counts add up."""
    return F.expr(group_text(grp)) == group


def worst_of(phi_a: Column, phi_b: Column) -> Column:
    """The larger mean; NULL if a group has no points, where `greatest` alone would skip it."""
    return F.when(phi_a.isNotNull() & phi_b.isNotNull(), F.greatest(phi_a, phi_b))


def standard_objective(assigned: DataFrame, dist2: str = "dist2") -> DataFrame:
    """One row `delta`: the mean squared distance to the nearest center."""
    return assigned.agg(F.avg(dist2).alias("delta"))


def fair_objective(assigned: DataFrame, dist2: str = "dist2", grp: str = "grp") -> DataFrame:
    """One row `phi_a, phi_b, phi`: the mean per group and the worse of the two."""
    means = assigned.agg(
        F.avg(F.when(_in(GROUP_A, grp), F.col(dist2))).alias("phi_a"),
        F.avg(F.when(_in(GROUP_B, grp), F.col(dist2))).alias("phi_b"),
    )
    return means.withColumn("phi", worst_of(F.col("phi_a"), F.col("phi_b")))


def _cluster_totals(assigned: DataFrame, by: Sequence[str], grp: str) -> DataFrame:
    return assigned.groupBy(*by, "k").agg(
        F.count_if(_in(GROUP_A, grp)).alias("n_a"),
        F.count_if(_in(GROUP_B, grp)).alias("n_b"),
        F.coalesce(F.sum(F.when(_in(GROUP_A, grp), F.col("dist2"))), F.lit(0.0)).alias("ss_a"),
        F.coalesce(F.sum(F.when(_in(GROUP_B, grp), F.col("dist2"))), F.lit(0.0)).alias("ss_b"),
    )


TOTALS = ("n_a", "n_b", "ss_a", "ss_b")


def _all_clusters(totals: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """`by..., k, n_a_k, n_b_k` for every k below `k`, next to the sums `n_a, n_b, ss_a, ss_b` of the model.

    The found clusters of a model, at most K, fold into one row that also holds
    a zero for every index; taken apart again, the two add up. Linear in K.
    """
    zeros = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.struct(i.alias("k"), F.lit(0).cast("bigint").alias("n_a_k"), F.lit(0).cast("bigint").alias("n_b_k")),
    )
    cell = F.struct(F.col("k").cast("int").alias("k"), F.col("n_a").alias("n_a_k"), F.col("n_b").alias("n_b_k"))
    model = totals.groupBy(*by).agg(
        F.collect_list(cell).alias("found"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS]
    )
    rows = model.select(*by, *TOTALS, F.inline(F.concat("found", zeros)))
    return rows.groupBy(*by, *TOTALS, "k").agg(F.sum("n_a_k").alias("n_a_k"), F.sum("n_b_k").alias("n_b_k"))


def _mean(total: str, count: str) -> Column:
    return F.when(F.col(count) > 0, F.col(total) / F.col(count))


def cluster_report(
    points: DataFrame,
    centers: Centers,
    by: Sequence[str] = (),
    strategy: str = "auto",
    cap: float | None = None,
) -> DataFrame:
    """K rows per `by`: the center, its group counts, and the totals and objectives of the whole set.

    Columns: `by..., k, center, n_a_k, n_b_k, n, n_a, n_b, delta, phi_a, phi_b, phi`.
    """
    rows = as_centers(centers)
    assigned = assign_nearest(points, rows, strategy, cap=cap)
    model = _all_clusters(_cluster_totals(assigned, by, "grp"), by, len(rows))
    n = F.col("n_a") + F.col("n_b")
    judged = model.select(
        *by,
        "k",
        F.expr(f"{table_text(rows)}[k]").alias("center"),
        "n_a_k",
        "n_b_k",
        n.alias("n"),
        "n_a",
        "n_b",
        F.when(n > 0, (F.col("ss_a") + F.col("ss_b")) / n).alias("delta"),
        _mean("ss_a", "n_a").alias("phi_a"),
        _mean("ss_b", "n_b").alias("phi_b"),
    )
    return judged.withColumn("phi", worst_of(F.col("phi_a"), F.col("phi_b")))


def cluster_group_counts(assigned: DataFrame, k: int, by: Sequence[str] = (), grp: str = "grp") -> DataFrame:
    """`(by..., k, n_a, n_b)` for every cluster index below `k`, empty ones included."""
    model = _all_clusters(_cluster_totals(assigned, by, grp), by, k)
    return model.select(*by, "k", F.col("n_a_k").alias("n_a"), F.col("n_b_k").alias("n_b"))


def compare_centers(points: DataFrame, models: dict[str, Centers], strategy: str = "auto") -> DataFrame:
    """One row per named center set: `model, n, n_a, n_b, delta, phi_a, phi_b, phi`, from a single scan."""
    df = points.select("point", "grp")
    aggregates = [F.count_if(_in(GROUP_A)).alias("n_a"), F.count_if(_in(GROUP_B)).alias("n_b")]
    for i, centers in enumerate(models.values()):
        df = assign_nearest(df, centers, strategy, dist2=f"_x{i}", index=f"_k{i}").drop(f"_k{i}")
        aggregates += [
            F.sum(F.when(_in(GROUP_A), F.col(f"_x{i}"))).alias(f"a{i}"),
            F.sum(F.when(_in(GROUP_B), F.col(f"_x{i}"))).alias(f"b{i}"),
        ]
    cells = [
        F.struct(F.lit(name).alias("model"), F.col(f"a{i}").alias("ss_a"), F.col(f"b{i}").alias("ss_b"))
        for i, name in enumerate(models)
    ]
    rows = df.agg(*aggregates).select("n_a", "n_b", F.inline(F.array(*cells)))
    n = F.col("n_a") + F.col("n_b")
    both = F.coalesce(F.col("ss_a"), F.lit(0.0)) + F.coalesce(F.col("ss_b"), F.lit(0.0))
    return rows.select(
        "model",
        n.alias("n"),
        "n_a",
        "n_b",
        F.when(n > 0, both / n).alias("delta"),
        _mean("ss_a", "n_a").alias("phi_a"),
        _mean("ss_b", "n_b").alias("phi_b"),
    ).withColumn("phi", worst_of(F.col("phi_a"), F.col("phi_b")))
