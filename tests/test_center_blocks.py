"""Very many centers: the same bits as comparing with all of them."""

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from pointflow.operators import assign, center_blocks, metrics

SMALL = {"block_bytes": 24 * 40, "pass_bytes": 24 * 80}


def frames(spark, points, centers):
    p = spark.createDataFrame([(i, [float(v) for v in row], i % 2) for i, row in enumerate(points)], "id int, point array<double>, grp int")
    c = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(centers)], "k int, center array<double>")
    return p, c


def plain(points, centers):
    dist2, index = assign.nearest_in_block(np.asarray(points, dtype=float), np.asarray(centers, dtype=float))
    return [(i, d, k) for i, (d, k) in enumerate(zip(dist2.tolist(), index.tolist()))]


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e160])
def test_equals_the_comparison_with_all(spark, offset):
    rng = np.random.default_rng(3)
    hubs = rng.normal(0, 50, (12, 3))
    centers = np.concatenate([hubs[i % 12] + rng.normal(0, 1, 3) for i in range(200)]).reshape(-1, 3)
    # ties: centers that repeat, and points in the middle of two
    centers[150:170] = centers[:20]
    points = np.concatenate([hubs[i % 12] + rng.normal(0, 1, 3) for i in range(400)]).reshape(-1, 3)
    points = np.concatenate([points, centers[:30], np.round(points[:50])]) + offset
    centers = np.concatenate([centers, np.round(points[400:420] - offset)]) + offset
    p, c = frames(spark, points, centers)
    with np.errstate(over="ignore"):
        want = plain(points, centers)
    for options in ({}, SMALL):
        got = center_blocks.assign_nearest_blocks(p, c.repartition(3), skipped="skipped", **options)
        rows = sorted(map(tuple, got.select("id", "dist2", "k").collect()))
        assert rows == want
        assert got.columns == ["id", "point", "grp", "dist2", "k", "skipped"]
    if not offset:
        assert got.agg(F.sum("skipped")).first()[0] > 0.5 * len(points) * len(centers)


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e160])
def test_pivots_equal_the_comparison_with_all(spark, offset):
    """Coordinates beyond BOX_DIMS, with ties."""
    rng = np.random.default_rng(4)
    hubs = rng.normal(0, 50, (12, center_blocks.BOX_DIMS + 1))
    draw = lambda n: np.concatenate([hubs[[i % 12]] + rng.normal(0, 1, hubs[:1].shape) for i in range(n)])
    centers = draw(200)
    centers[150:170] = centers[:20]
    points = np.concatenate([draw(300), centers[:30]]) + offset
    p, c = frames(spark, points, centers + offset)
    with np.errstate(over="ignore"):
        want = plain(points, centers + offset)
    got = center_blocks.assign_nearest_blocks(p, c, block_bytes=72 * 60, pass_bytes=72 * 130)
    assert sorted(map(tuple, got.select("id", "dist2", "k").collect())) == want


def test_boxes_leave_out_nearly_all_centers():
    """Points far from all centers, on a grid with ties and equal centers, meet few of them."""
    rng = np.random.default_rng(6)
    centers = np.concatenate([rng.integers(0, 60, (20_000, 2)).astype(float), rng.normal(30, 10, (20_000, 2))])
    points = np.concatenate([rng.normal(30, 20, (300, 2)), rng.normal(30, 20, (300, 2)) + [0, 5000], rng.integers(0, 60, (100, 2)) + 0.5])
    ks = rng.permutation(len(centers))
    best, index = np.full(len(points), np.inf), np.full(len(points), center_blocks.NONE)
    skipped = center_blocks.improve(points, [center_blocks.make_boxes(ks, centers)], best, index)
    by_index = np.argsort(ks)
    dist2, at = assign.nearest_in_block(points, centers[by_index])
    assert best.tolist() == dist2.tolist() and index.tolist() == ks[by_index][at].tolist()
    assert skipped > 0.99 * len(points) * len(centers)


def test_points_that_are_not_finite(spark):
    points = [[float("nan"), 1.0], [float("inf"), 0.0], [1e200, 0.0], [2.0, 2.0]]
    centers = [[0.0, 0.0]] + [[i + 0.5, 0.0] for i in range(200)]
    p, c = frames(spark, points, centers)
    got = center_blocks.assign_nearest_blocks(p, c, **SMALL).orderBy("id").collect()
    with np.errstate(over="ignore", invalid="ignore"):
        want = plain(points, centers)
    assert repr([(r["id"], r["dist2"], r["k"]) for r in got]) == repr(want)


def test_odd_input_is_refused(spark):
    p, c = frames(spark, [[1.0, 2.0]], [[0.0, 0.0], [1.0, 1.0]])
    run = center_blocks.assign_nearest_blocks
    bad = [c.where("false"), c.union(c), c.union(spark.createDataFrame([(9, [1.0])], c.schema)), c.union(spark.createDataFrame([(9, None)], c.schema)), c.union(spark.createDataFrame([(9, [1.0, float("nan")])], c.schema)), c.union(spark.createDataFrame([(None, [1.0, 2.0])], c.schema))]
    for centers in bad:
        with pytest.raises(ValueError):
            run(p, centers)
    for point in (None, [1.0], [1.0, None]):
        with pytest.raises(PythonException):
            run(spark.createDataFrame([(1, point, 0)], p.schema), c).collect()
    assert run(p.where("false"), c).count() == 0


def test_report_equals_the_report_of_a_list(spark):
    rng = np.random.default_rng(5)
    centers = [*rng.normal(0, 10, (30, 2)), [1e9, 1e9]]
    p, c = frames(spark, rng.normal(0, 10, (300, 2)), centers)
    got = center_blocks.cluster_report_blocks(p, c, **{**SMALL, "block_bytes": 160}).orderBy("k")
    want = metrics.cluster_report(p, [list(map(float, x)) for x in centers]).orderBy("k")
    assert got.columns == want.columns
    for a, b in zip(got.collect(), want.collect(), strict=True):
        assert list(a)[:7] == list(b)[:7] and list(a)[7:] == pytest.approx(list(b)[7:])
    none = center_blocks.cluster_report_blocks(p.where("false"), c).first()
    assert (none["n"], none["n_a_k"], none["delta"], none["phi"]) == (0, 0, None, None)
