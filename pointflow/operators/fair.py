"""Fair centers: per-cluster group statistics, the line search, and fair Lloyd rounds.

A *model* is one row per value of `by` (one row in all without it) that holds
its K clusters as an array, so any number of models is solved in one job. Two
readings of the statistics are offered:

* `cluster_means` takes the group means of a cluster as if each were a single
  point. Shares are then equal, the scatter is zero, and a new center is the
  midpoint of the two means.
* `population` takes all points: shares and scatter weigh the clusters, which
  is Fair-Lloyd as published by Ghadiri, Samadi and Vempala (2021).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.functions.vectors import table_text
from pointflow.operators.assign import Centers, as_centers
from pointflow.operators.kmeans import held, kmeans_init
from pointflow.operators.partials import cluster_group_sums, scatter_text

SELECTIONS = ("cluster_means", "population")

# what one cluster adds to the total of its group
_WEIGHT = {"cluster_means": "if(n > 0, 1D, 0D)", "population": "CAST(n AS DOUBLE)"}

# fixed values of the search
GAMMA_START = 0.5
POWER_START = 0.5
SEARCH_STEPS = 10
# relative width at which the two costs count as equal
SEARCH_TOLERANCE = 1e-12


def fair_models(
    sums: DataFrame, centers: Centers, by: Sequence[str] = (), selection: str = "cluster_means"
) -> DataFrame:
    """`(by..., clusters, fixed_a, fixed_b)` from `cluster_group_sums`.

    `clusters` is sorted by `k` and holds `k, n_a, n_b, alpha, beta, mean_a,
    mean_b, ell` for every cluster with a point. Where one group is missing its
    mean is the other's and `ell` is 0. The scatter is taken from the moments of
    `sums` if they are there.
    """
    if selection not in SELECTIONS:
        raise ValueError(f"selection must be one of {SELECTIONS}")
    population = selection == "population"
    # the constant table is indexed by `k`, so the old centers need no join
    delta = "0D"
    if population:
        delta = "m2" if "m2" in sums.columns else scatter_text(f"{table_text(as_centers(centers))}[k]")
    measured = sums.selectExpr(
        *by, "k", "grp", "n", "transform(sum, s -> s / n) AS mean", f"{delta} AS delta"
    )
    picks = [
        f"max({column}) FILTER (WHERE grp = {group}) AS {column}_{side}"
        for group, side in ((0, "a"), (1, "b"))
        for column in ("n", "delta", "mean")
    ]
    weight = _WEIGHT[selection]
    sides = {"a": 0, "b": 1}
    # the cells of a model meet once, sorted, so the two groups of a cluster are neighbours
    model = measured.groupBy(*by).agg(
        F.expr(f"array_sort(collect_list(struct(k, grp, n, mean, {weight} AS w)))").alias("cells"),
        *[F.expr(f"coalesce(sum({weight}) FILTER (WHERE grp = {g}), 0D)").alias(f"total_{s}") for s, g in sides.items()],
        *[F.expr(f"coalesce(sum(delta) FILTER (WHERE grp = {g}), 0D)").alias(f"delta_{s}") for s, g in sides.items()],
    )
    # `get` gives NULL before the first cell and after the last one
    firsts = "filter(transform(cells, (c, i) -> i), i -> NOT get(cells, i - 1).k <=> get(cells, i).k)"
    here, then = "get(cells, i)", "get(cells, i + 1)"
    pairs = f"""transform({firsts}, i -> named_struct(
        'k', {here}.k,
        'a', if({here}.grp = 0, {here}, NULL),
        'b', if({here}.grp = 1, {here}, if({then}.k <=> {here}.k, {then}, NULL))))"""
    return model.withColumn("pairs", F.expr(pairs)).selectExpr(
        *by,
        """transform(pairs, p -> struct(
            p.k AS k, coalesce(p.a.n, 0L) AS n_a, coalesce(p.b.n, 0L) AS n_b,
            if(total_a = 0, 0D, coalesce(p.a.w, 0D) / total_a) AS alpha,
            if(total_b = 0, 0D, coalesce(p.b.w, 0D) / total_b) AS beta,
            coalesce(p.a.mean, p.b.mean) AS mean_a,
            coalesce(p.b.mean, p.a.mean) AS mean_b,
            coalesce(sqrt(aggregate(
                zip_with(p.a.mean, p.b.mean, (u, v) -> (u - v) * (u - v)), 0D, (u, v) -> u + v)), 0D) AS ell
        )) AS clusters""",
        "if(total_a = 0, 0D, delta_a / total_a) AS fixed_a",
        "if(total_b = 0, 0D, delta_b / total_b) AS fixed_b",
    )


def fair_stats(models: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per cluster: `by..., k, n_a, n_b, alpha, beta, mean_a, mean_b, ell`."""
    return models.select(*by, F.inline("clusters"))


def line_search_text() -> str:
    """The distances `x` from the A means at which the two group costs come closest, as SQL over a model row.

    Halving steps on gamma, ten at most; the result belongs to the gamma before
    the last step. A cluster of no weight in either group gets x = 0. SQL
    lambdas have no `let`: `transform(array(v), v -> ...)[0]` evaluates v once.
    """
    heavy = "(s.gamma * c.alpha + (1 - s.gamma) * c.beta)"
    place = f"transform(clusters, c -> if({heavy} = 0, 0D, (1 - s.gamma) * c.beta * c.ell / {heavy}))"
    cost_a = "aggregate(zip_with(clusters, x, (c, v) -> c.alpha * v * v), fixed_a, (u, v) -> u + v)"
    cost_b = "aggregate(zip_with(clusters, x, (c, v) -> c.beta * (c.ell - v) * (c.ell - v)), fixed_b, (u, v) -> u + v)"
    equal = f"abs(f.a - f.b) <= {SEARCH_TOLERANCE!r}D * greatest(f.a, f.b)"
    move = f"""named_struct(
        'gamma', CASE WHEN {equal} THEN s.gamma
                      WHEN f.a > f.b THEN s.gamma + s.power / 2
                      ELSE s.gamma - s.power / 2 END,
        'power', s.power / 2, 'done', {equal}, 'x', x)"""
    step = f"transform(array({place}), x -> transform(array(struct({cost_a} AS a, {cost_b} AS b)), f -> {move})[0])[0]"
    return f"""aggregate(
        sequence(1, {SEARCH_STEPS}),
        named_struct('gamma', {GAMMA_START!r}D, 'power', {POWER_START!r}D, 'done', false,
                     'x', transform(clusters, c -> 0D)),
        (s, t) -> if(s.done, s, {step}),
        s -> s.x)"""


def fair_line_search(models: DataFrame) -> DataFrame:
    """Adds `x`, one distance per entry of `clusters`, for all models in one job."""
    return models.selectExpr("*", f"{line_search_text()} AS x")


def fair_centroids(searched: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`(by..., k, x, center)` for every cluster with a point; the others keep whatever center they had."""
    rows = searched.selectExpr(*by, "inline(zip_with(clusters, x, (c, x) -> struct(c, x)))")
    center = """if(c.ell = 0, c.mean_a,
        zip_with(c.mean_a, c.mean_b, (a, b) -> (c.ell - x) / c.ell * a + x / c.ell * b))"""
    return rows.selectExpr(*by, "c.k AS k", "x", f"{center} AS center")


def fair_lloyd(
    points: DataFrame,
    centers: Centers | None = None,
    rounds: int = 1,
    selection: str = "cluster_means",
    k: int | None = None,
    seed: int = 42,
    strategy: str = "auto",
    persist: bool = False,
) -> list[list[float]]:
    """Exactly `rounds` fair rounds from `centers`, or from the k-means|| start of `k` centers.

    One aggregation over the points per round. Its K rows come back to be the
    next round's literals; a cluster without points keeps its center.
    """
    if selection not in SELECTIONS:
        raise ValueError(f"selection must be one of {SELECTIONS}")
    slim = points.select("point", "grp")
    with held(slim, persist and rounds > 1) as kept:
        if centers is None:
            if k is None:
                raise ValueError("give either centers or k")
            centers = kmeans_init(kept, k, seed)
        current = as_centers(centers)
        for _ in range(rounds):
            sums = cluster_group_sums(kept, current, strategy=strategy, moments=selection == "population")
            chosen = fair_centroids(fair_line_search(fair_models(sums, current, selection=selection)))
            for row in chosen.select("k", "center").collect():
                current[row["k"]] = list(row["center"])
    return current


def group_scatter(sums: DataFrame, centers: Centers, by: Sequence[str] = ()) -> DataFrame:
    """`(by..., delta_a, delta_b)`: mean squared distance of each group's points to their cluster's group mean."""
    models = fair_models(sums, centers, by, "population")
    return models.select(*by, F.col("fixed_a").alias("delta_a"), F.col("fixed_b").alias("delta_b"))
