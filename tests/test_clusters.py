import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import brute
from pointflow.functions import vectors
from pointflow.operators import assign, fair, kmeans, metrics, partials

SCHEMA = "point array<double>, grp int"
CENTERS = [[0.0, 0.0], [5.0, 5.0], [9.0, 1.0]]


def cloud(n=400, dims=2, seed=3, hot=0.35):
    """Random points of which a third sit on one spot."""
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        spot = [4.0] * dims if draw.random() < hot else [round(draw.uniform(0, 10), 3) for _ in range(dims)]
        out.append((spot, int(draw.random() < 0.3)))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def close(got, want, tol=1e-9):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=tol)


@pytest.mark.parametrize("k, dims", [(1, 1), (3, 2), (7, 5), (30, 8)])
def test_strategies_agree_to_the_bit(spark, k, dims):
    draw = random.Random(k)
    centers = [[draw.uniform(0, 10) for _ in range(dims)] for _ in range(k)]
    data = cloud(200, dims)
    want = sorted((p, *brute.nearest(p, centers)[::-1]) for p, _ in data)
    for strategy in ("unrolled", "lambda", "arrow", "auto"):
        rows = assign.assign_nearest(frame(spark, data), centers, strategy).collect()
        got = sorted((r["point"], r["dist2"], r["k"]) for r in rows)
        assert [(p, k) for p, _, k in got] == [(p, k) for p, _, k in want], strategy
        close([d for _, d, _ in got], [d for _, d, _ in want], 1e-12)


@pytest.mark.parametrize("strategy", ["unrolled", "lambda", "arrow"])
def test_ties_caps_and_widths(spark, strategy):
    data = frame(spark, [([1.0, 0.0], 0)])
    tie = [[2.0, 0.0], [0.0, 0.0], [1.0, 1.0]]
    assert assign.assign_nearest(data, tie, strategy).first()["k"] == 0
    capped = assign.assign_nearest(data, [[9.0, 9.0], [5.0, 0.0]], strategy, cap=10.0).first()
    assert (capped["dist2"], capped["k"]) == (10.0, 0)
    with pytest.raises(PySparkException, match="does not have 3 coordinates"):
        assign.assign_nearest(data, [[1.0, 2.0, 3.0]], strategy).collect()
    huge = frame(spark, [([1e200, 0.0], 0), ([1.0, 0.0], 0)])
    got = {r["point"][0]: r["k"] for r in assign.nearest_index(huge, [[0.0, 0.0], [-1.0, 0.0]], strategy).collect()}
    assert got == {1e200: -1, 1.0: 0}


def test_center_sets_are_checked(spark):
    for bad in ([], [[]], [[1.0], [1.0, 2.0]], [[float("nan")]]):
        with pytest.raises(ValueError):
            assign.as_centers(bad)
    assert assign.collect_centers(assign.centers_frame(spark, CENTERS)) == CENTERS
    with pytest.raises(ValueError):
        assign.assign_nearest(frame(spark, cloud(2)), CENTERS, "best")


def test_report_and_objectives(spark):
    data = cloud()
    near = [(brute.nearest(p, CENTERS), g) for p, g in data]
    side = {g: [d for (_, d), h in near if h == g] for g in (0, 1)}
    phi = [sum(side[g]) / len(side[g]) for g in (0, 1)]
    delta = sum(side[0] + side[1]) / len(data)
    far = [*CENTERS, [500.0, 500.0]]
    report = metrics.cluster_report(frame(spark, data), far).orderBy("k").collect()
    assert [r["center"] for r in report] == far
    for r in report:
        assert r["n_a_k"] == sum(1 for (k, _), g in near if k == r["k"] and g == 0)
        assert r["n_b_k"] == sum(1 for (k, _), g in near if k == r["k"] and g == 1)
        close([r["delta"], r["phi_a"], r["phi_b"], r["phi"]], [delta, *phi, max(phi)])
    assert sum(r["n_a_k"] + r["n_b_k"] for r in report) == report[0]["n"] == len(data)
    assert max(phi) >= delta
    assigned = assign.assign_nearest(frame(spark, data), far)
    close(metrics.standard_objective(assigned).first(), [delta])
    close(metrics.fair_objective(assigned).first(), [*phi, max(phi)])
    counts = metrics.cluster_group_counts(assigned, 4).orderBy("k").collect()
    assert [(r["n_a"], r["n_b"]) for r in counts] == [(r["n_a_k"], r["n_b_k"]) for r in report]
    both = metrics.compare_centers(frame(spark, data), {"one": far, "two": [[4.0, 4.0]]}).collect()
    assert [r["model"] for r in both] == ["one", "two"]
    close([both[0]["delta"], both[0]["phi"]], [delta, max(phi)])


def test_a_missing_group_has_no_fair_objective(spark):
    data = frame(spark, [([1.0, 1.0], 0), ([2.0, 2.0], 0)])
    row = metrics.fair_objective(assign.assign_nearest(data, CENTERS)).first()
    assert row["phi_a"] is not None and row["phi_b"] is None and row["phi"] is None
    assert metrics.cluster_report(data, CENTERS).first()["phi"] is None
    assert metrics.compare_centers(data, {"c": CENTERS}).first()["phi"] is None


def test_reports_by_segment(spark):
    data = frame(spark, cloud()).withColumn("seg", F.when(F.col("point")[0] > 5, "hi").otherwise("lo"))
    whole = {r["seg"]: r for r in metrics.cluster_report(data, CENTERS, by=["seg"]).where("k = 1").collect()}
    for seg in ("hi", "lo"):
        alone = metrics.cluster_report(data.where(F.col("seg") == seg), CENTERS).where("k = 1").first()
        assert alone["n_a_k"] == whole[seg]["n_a_k"]
        close([alone["delta"], alone["phi"]], [whole[seg]["delta"], whole[seg]["phi"]])


@pytest.mark.parametrize("strategy", ["unrolled", "arrow"])
@pytest.mark.parametrize("by", [(), ("seg",)])
def test_group_sums(spark, strategy, by):
    data = cloud()
    points = frame(spark, data).withColumn("seg", F.when(F.col("point")[1] > 3, "u"))
    want = {}
    for p, g in data:
        k, dist2 = brute.nearest(p, CENTERS)
        key = (*((("u" if p[1] > 3 else None),) if by else ()), k, g)
        n, total, ss = want.get(key, (0, [0.0, 0.0], 0.0))
        want[key] = (n + 1, [a + b for a, b in zip(total, p)], ss + dist2)
    rows = partials.cluster_group_sums(points, CENTERS, by, strategy).collect()
    got = {(*[r[c] for c in by], r["k"], r["grp"]): (r["n"], r["sum"], r["ss"]) for r in rows}
    assert got.keys() == want.keys()
    for key, (n, total, ss) in want.items():
        assert got[key][0] == n
        close([*got[key][1], got[key][2]], [*total, ss])


def test_wide_sums_go_through_rows(spark):
    dims = partials.WIDE_DIMS + 20
    draw = random.Random(1)
    data = [([draw.random() for _ in range(dims)], i % 2) for i in range(60)]
    centers = [data[0][0], data[1][0], data[2][0]]
    rows = partials.cluster_group_means(partials.cluster_group_sums(frame(spark, data), centers)).collect()
    assert sum(r["n"] for r in rows) == 60
    for r in rows:
        members = [p for p, g in data if (brute.nearest(p, centers)[0], g) == (r["k"], r["grp"])]
        assert r["n"] == len(members)
        close(r["mean"], brute.mean(members))
        assert r["ss"] == pytest.approx(sum(brute.nearest(p, centers)[1] for p in members))


def test_mean_vector(spark):
    data = frame(spark, [([1.0, 2.0], 0), ([3.0, 6.0], 1)])
    assert tuple(partials.mean_vector(data).first()) == (2, [2.0, 4.0])
    assert tuple(partials.mean_vector(data.where("grp > 5"), dims=2).first()) == (0, None)


def test_lloyd(spark):
    data = cloud()
    points = frame(spark, data)
    far = [*CENTERS, [500.0, 500.0]]
    for strategy, persist in (("unrolled", False), ("arrow", True)):
        close(kmeans.lloyd(points, far, 4, strategy, persist=persist), brute.lloyd(data, far, 4))
    costs = [
        metrics.standard_objective(assign.assign_nearest(points, kmeans.lloyd(points, CENTERS, r))).first()[0]
        for r in range(4)
    ]
    assert costs == sorted(costs, reverse=True)


def test_kmeans_is_seeded_and_reports_fewer_centers(spark):
    points = frame(spark, cloud())
    assert kmeans.kmeans_fit(points, 3, 10) == kmeans.kmeans_fit(points, 3, 10)
    assert len(kmeans.kmeans_init(points, 3)) == 3
    twins = frame(spark, [([0.0, 0.0], 0), ([1.0, 1.0], 0)] * 10)
    assert len(kmeans.kmeans_fit(twins, 4, 5)) == 2


@pytest.mark.parametrize("selection", fair.SELECTIONS)
@pytest.mark.parametrize("strategy", ["unrolled", "arrow"])
def test_fair_lloyd(spark, selection, strategy):
    data = cloud()
    want = brute.fair_lloyd(data, CENTERS, 3, selection == "population")
    close(fair.fair_lloyd(frame(spark, data), CENTERS, 3, selection, strategy=strategy), want, 1e-7)


def test_cluster_means_give_midpoints(spark):
    data = cloud()
    sums = partials.cluster_group_sums(frame(spark, data), CENTERS)
    rows = fair.fair_centroids(fair.fair_line_search(fair.fair_models(sums, CENTERS))).collect()
    stats = {r["k"]: r for r in fair.fair_stats(fair.fair_models(sums, CENTERS)).collect()}
    for r in rows:
        s = stats[r["k"]]
        assert r["x"] == pytest.approx(s["ell"] / 2)
        close(r["center"], [(a + b) / 2 for a, b in zip(s["mean_a"], s["mean_b"])])


def test_missing_groups_and_empty_clusters(spark):
    # cluster 0 has group A only, cluster 1 both, cluster 2 B only, cluster 3 nothing
    data = [([0.0, 0.0], 0), ([1.0, 1.0], 0), ([10.0, 0.0], 0), ([10.0, 2.0], 1), ([20.0, 0.0], 1)]
    centers = [[0.0, 0.0], [10.0, 1.0], [20.0, 1.0], [99.0, 99.0]]
    for selection in fair.SELECTIONS:
        got = fair.fair_lloyd(frame(spark, data), centers, 1, selection)
        close(got, brute.fair_lloyd(data, centers, 1, selection == "population"))
        assert got[0] == [0.5, 0.5] and got[2] == [20.0, 0.0] and got[3] == [99.0, 99.0]
    one_group = [([0.0, 0.0], 0), ([4.0, 0.0], 0)]
    assert fair.fair_lloyd(frame(spark, one_group), [[1.0, 0.0]], 1, "population") == [[2.0, 0.0]]


def test_line_search_solves_many_models(spark):
    draw = random.Random(7)
    models = []
    for m in range(150):
        k = draw.randint(1, 6)
        share = [[draw.random() * (draw.random() > 0.2) for _ in range(k)] for _ in range(2)]
        alpha, beta = [[v / sum(s) if sum(s) else 0.0 for v in s] for s in share]
        ell = [draw.random() * 10 * (draw.random() > 0.1) for _ in range(k)]
        models.append((m, draw.random() * 5, draw.random() * 5, list(zip(range(k), alpha, beta, ell))))
    schema = "m int, fixed_a double, fixed_b double, clusters array<struct<k int, alpha double, beta double, ell double>>"
    rows = {r["m"]: r["x"] for r in fair.fair_line_search(spark.createDataFrame(models, schema)).collect()}
    for m, fixed_a, fixed_b, clusters in models:
        _, alpha, beta, ell = map(list, zip(*clusters))
        close(rows[m], brute.search(fixed_a, fixed_b, alpha, beta, ell))
        assert all(-1e-12 <= x <= length + 1e-12 for x, length in zip(rows[m], ell))


def test_fair_models_by_segment_equal_separate_ones(spark):
    points = frame(spark, cloud()).withColumn("seg", F.when(F.col("point")[0] > 5, 1).otherwise(0))
    def centers_of(df, by):
        models = fair.fair_models(partials.cluster_group_sums(df, CENTERS, by), CENTERS, by, "population")
        return fair.fair_centroids(fair.fair_line_search(models), by)
    together = {(r["seg"], r["k"]): r["center"] for r in centers_of(points, ["seg"]).collect()}
    for seg in (0, 1):
        for r in centers_of(points.where(F.col("seg") == seg), []).collect():
            close(r["center"], together[seg, r["k"]])


def test_scatter(spark):
    data = cloud()
    sums = partials.cluster_group_sums(frame(spark, data), CENTERS)
    got = fair.group_scatter(sums, CENTERS).first()
    for g, value in enumerate(got):
        sets = {}
        for p, h in data:
            if h == g:
                sets.setdefault(brute.nearest(p, CENTERS)[0], []).append(p)
        total = sum(brute.d2(p, brute.mean(s)) for s in sets.values() for p in s)
        assert value == pytest.approx(total / sum(map(len, sets.values())))


def test_bad_arguments(spark):
    points = frame(spark, cloud(5))
    with pytest.raises(ValueError):
        fair.fair_lloyd(points, CENTERS, 1, "other")
    with pytest.raises(ValueError):
        fair.fair_lloyd(points)


def test_vectors(spark):
    p, q = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(4.0), F.lit(6.0))
    row = spark.range(1).select(
        vectors.sqdist(p, q), vectors.distance(p, q), vectors.add(p, q), vectors.scale(p, F.lit(3.0)),
        vectors.zeros(2), vectors.blend(p, q, F.lit(1.0), F.lit(4.0)), vectors.blend(p, q, F.lit(0.0), F.lit(0.0)),
        vectors.sqdist(p, vectors.zeros(3)),
    ).first()
    assert list(row) == [25.0, 5.0, [5.0, 8.0], [3.0, 6.0], [0.0, 0.0], [1.75, 3.0], [1.0, 2.0], None]
