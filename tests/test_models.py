"""Lloyd rounds with carried bounds and per segment, against plain Lloyd and plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointflow.operators import assign, bounded_lloyd, keyed_lloyd, kmeans, words

POINTS = "segment string, point array<double>"


def cloud(spark, n, dims, spots, seed=5):
    rng = np.random.default_rng(seed)
    places = rng.uniform(-50, 50, (spots, dims))
    rows = places[rng.integers(0, spots, n)] + rng.normal(0, 3, (n, dims))
    frame = spark.createDataFrame([(r.tolist(),) for r in rows], "point array<double>").repartition(3)
    return frame, rows, places


@pytest.mark.parametrize("dims, k", [(2, 5), (8, 20)])
def test_bounded_rounds_equal_plain_rounds(spark, dims, k):
    frame, rows, places = cloud(spark, 1500, dims, k)
    start = rows[:k].tolist()
    got, shares = bounded_lloyd.lloyd_bounded(frame, start, 20)
    want = kmeans.lloyd(frame, start, 20)
    assert np.abs(np.array(got) - np.array(want)).max() < 1e-9
    assert len(shares) == 20 and shares[0] == 0 and max(shares) > 0.5
    near = lambda centers: [r["k"] for r in assign.assign_nearest(frame, centers).collect()]
    assert near(got) == near(want)


def test_bounded_rounds_with_ties_and_odd_sets(spark):
    grid = [[float(x), float(y)] for x in range(6) for y in range(6)]
    frame = spark.createDataFrame([(p,) for p in grid * 3], "point array<double>").repartition(2)
    # equal centers, a center without points, and points half way between two
    for start in ([[0.0, 0.0], [0.0, 0.0], [4.0, 4.0]], [[1.0, 1.0], [3.0, 1.0], [99.0, 99.0]], [[2.5, 2.5]]):
        got, _ = bounded_lloyd.lloyd_bounded(frame, start, 6)
        assert np.allclose(got, kmeans.lloyd(frame, start, 6), atol=1e-12)
    empty = frame.where("false")
    assert bounded_lloyd.lloyd_bounded(empty, [[1.0, 2.0]], 2) == ([[1.0, 2.0]], [0.0, 0.0])
    missing = spark.createDataFrame([([1.0, None],)], "point array<double>")
    with pytest.raises(Exception, match="NULL coordinate"):
        bounded_lloyd.lloyd_bounded(missing, [[1.0, 2.0]], 1)


def test_bounds_hold_far_from_the_origin(spark):
    frame, rows, _ = cloud(spark, 400, 3, 4)
    moved = frame.select(F.transform("point", lambda v: v * 1e-3 + 1e6).alias("point"))
    start = (rows[:4] * 1e-3 + 1e6).tolist()
    got, _ = bounded_lloyd.lloyd_bounded(moved, start, 10)
    assert np.abs(np.array(got) - np.array(kmeans.lloyd(moved, start, 10))).max() < 1e-8


def segments(spark):
    rng = random.Random(3)
    rows = [("hot", [rng.gauss(0, 9), rng.gauss(0, 9)]) for _ in range(300)]
    rows += [(s, [rng.gauss(4, 5), rng.gauss(1, 5)]) for s in ("a", "b", None) for _ in range(60)]
    centers = [
        (s, i, [float(i), float(-i) + len(s or "")]) for s, n in (("hot", 4), ("a", 1), ("b", 3), (None, 2), ("idle", 2)) for i in range(n)
    ]
    return rows, centers


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_segments_equal_lloyd_in_each_segment(spark, bound):
    rows, centers = segments(spark)
    frame = spark.createDataFrame(rows, POINTS).repartition(3)
    start = spark.createDataFrame(centers, "segment string, k int, center array<double>")
    found = keyed_lloyd.lloyd_by(frame, start, ["segment"], 4, broadcast_bytes=bound).collect()
    assert len(found) == len(centers)
    got = {(r["segment"], r["k"]): r["center"] for r in found}
    for s in {c[0] for c in centers}:
        own = [c[2] for c in centers if c[0] == s]
        part = frame.where(F.col("segment").eqNullSafe(F.lit(s)))
        want = kmeans.lloyd(part, own, 4)
        assert np.allclose([got[s, i] for i in range(len(own))], want, atol=1e-9), s


def test_segments_assign_ties_and_refusals(spark):
    frame = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [3.0, 0.0])], POINTS)
    cells = "segment string, k int, center array<double>"
    start = spark.createDataFrame([("a", 1, [2.0, 0.0]), ("a", 0, [2.0, 0.0])], cells)
    assert [r["k"] for r in keyed_lloyd.assign_by(frame, start, ["segment"]).collect()] == [0, 0]
    assert keyed_lloyd.lloyd_by(frame, start, ["segment"], 0).count() == 2
    assert keyed_lloyd.lloyd_by(frame.where("false"), start, ["segment"], 1).count() == 2
    with pytest.raises(Exception, match="a segment has no centers"):
        keyed_lloyd.assign_by(frame.withColumn("segment", F.lit("z")), start, ["segment"]).collect()
    with pytest.raises(Exception, match="does not have 2 coordinates"):
        keyed_lloyd.assign_by(frame.withColumn("point", F.array(F.lit(1.0))), start, ["segment"]).collect()
    for bad in ([("a", 0, [1.0]), ("a", 0, [2.0])], [("a", 0, [1.0]), ("b", 0, [2.0, 3.0])], [("a", 0, [float("nan")])], [("a", None, [1.0])], []):
        with pytest.raises(ValueError):
            keyed_lloyd.lloyd_by(frame, spark.createDataFrame(bad, cells), ["segment"], 1)


def test_hot_words_are_counted_as_others(spark):
    rng = random.Random(9)
    texts = [" ".join(["the"] * rng.randint(0, 40) + [rng.choice("abcdef") * rng.randint(1, 9) for _ in range(20)]) for _ in range(300)]
    lines = spark.createDataFrame([(t,) for t in [*texts, "", "  ", None]], "value string").repartition(5)
    want = sorted(map(tuple, words.word_count(lines).collect()))
    assert sorted(map(tuple, words.word_count_salted_hot(lines, one_in=1).collect())) == want
    # named words need not occur, nor be hot
    for hot in ({"the": 0.9, "none": 0.5}, {"a": 1e-9}, {}):
        assert sorted(map(tuple, words.word_count_salted_hot(lines, 3, hot=hot).collect())) == want
    top = words.hot_words(lines, share=0.1)
    assert next(iter(top)) == "the" and abs(top["the"] - dict(want)["the"] / sum(n for _, n in want)) < 1e-9
    assert words.hot_words(lines.where("false")) == {} and words.word_count_salted_hot(lines.where("false")).count() == 0
    with pytest.raises(ValueError):
        words.word_count_salted_hot(lines, 0)


def test_hot_words_read_the_lines_once_and_send_the_rest_once(spark, tmp_path):
    spark.range(1000).selectExpr("concat('the w', id) AS value").write.parquet(str(tmp_path / "lines"))
    counts = words.word_count_salted_hot(spark.read.parquet(str(tmp_path / "lines")), hot={"the": 0.5})
    counts.collect()
    text = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text and text.count("FileScan") == 1, text
