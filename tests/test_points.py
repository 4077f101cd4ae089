import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pointflow.functions.draws import salt, uniform_pair
from pointflow.sources import blobs, items, points


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_parse_any_width_and_labels(spark):
    got = rows(points.parse_points(lines(spark, "1,2,A", "1.5,-2e1,3,B", "4,C", "5,AA")), "point", "label", "grp")
    assert got == [([1.0, 2.0], "A", 0), ([1.5, -20.0, 3.0], "B", 1), ([4.0], "C", 1), ([5.0], "AA", 1)]


def test_trailing_commas_are_no_fields(spark):
    assert rows(points.parse_points(lines(spark, "1,2,")), "point", "label", "grp") == [([1.0], "2", 1)]
    assert rows(points.parse_points(lines(spark, "1,2,A,,"), dims=2), "point", "grp") == [([1.0, 2.0], 0)]


@pytest.mark.parametrize("bad", ["", ",", "x,2,A", "NaN,2,A", "1,Infinity,A", "A", "1,,A"])
@pytest.mark.parametrize("dims", [None, 2])
def test_bad_lines_fail_or_go(spark, bad, dims):
    data = lines(spark, "1,2,A", bad)
    with pytest.raises(PySparkException, match="bad line"):
        points.parse_points(data, dims).collect()
    assert rows(points.parse_points(data, dims, on_bad="drop"), "point") == [([1.0, 2.0],)]


def test_other_widths_are_bad_when_dims_is_given(spark):
    data = lines(spark, "1,2,A", "1,2,3,A", "1,A")
    assert points.parse_points(data, 2, on_bad="drop").count() == 1
    with pytest.raises(ValueError):
        points.parse_points(data, on_bad="maybe")


def test_bad_lines_fail_even_if_only_the_group_is_read(spark):
    with pytest.raises(PySparkException, match="bad line"):
        points.parse_points(lines(spark, "x,A")).agg(F.sum("grp")).collect()


def test_two_dimensional_parse_ignores_the_rest(spark):
    got = rows(points.parse_points_2d(lines(spark, "1,2,A,B", "3,4")), "point", "label", "grp")
    assert got == [([1.0, 2.0], "A", 0), ([3.0, 4.0], None, 1)]


def test_groups_by_suffix_and_by_label(spark):
    data = lines(spark, "1,2,A", "1,2,AA", "3,4,B", "5,6,C")
    assert rows(points.group_counts(data), "n", "n_a_suffix", "n_b_suffix", "n_a_label") == [(4, 2, 2, 1)]
    parts = {r["part"]: r["count"] for r in points.split_groups(data).groupBy("part").count().collect()}
    assert parts == {"U": 4, "A": 2, "B": 1}
    assert points.filter_suffix(data, "A").count() == 2


def test_points_round_trip(spark, tmp_path):
    data = points.parse_points(lines(spark, "1.23456,-0.5,A", "1000000,2.0005,B"))
    points.write_points(data, str(tmp_path / "out"))
    text = sorted(r[0] for r in points.read_lines(spark, str(tmp_path / "out")).collect())
    assert text == ["1.235,-0.500,A", "1000000.000,2.001,B"]


def test_load_parts(spark):
    assert points.load_parts(spark.range(100), 5).rdd.getNumPartitions() == 5
    with pytest.raises(ValueError):
        points.load_parts(spark.range(1), 0)


@pytest.mark.parametrize("text, item", [("7", 7), ("-7", -7), ("+7", 7), (" 7", None), ("7 ", None), ("", None),
                                        ("7.0", None), ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None)])
def test_items(spark, text, item):
    data = lines(spark, text)
    assert rows(items.parse_items(data, on_bad="drop"), "item") == ([] if item is None else [(item,)])
    if item is None:
        with pytest.raises(PySparkException, match="bad line"):
            items.parse_items(data).collect()


@pytest.mark.parametrize("n, k", [(10, 3), (7, 7), (100, 1), (23, 5)])
def test_blob_sizes(spark, n, k):
    got = {}
    for r in blobs.gen_blobs(spark, n, k).groupBy("cluster", "label").count().collect():
        got.setdefault(r["cluster"], {})[r["label"]] = r["count"]
    for i in range(k):
        size = n // k + (i < n % k)
        major = int(size * 0.8)
        want = {"AB"[i % 2]: major, "BA"[i % 2]: size - major}
        assert got[i] == {label: c for label, c in want.items() if c}


def test_blobs_do_not_depend_on_partitions_or_order(spark):
    one = sorted(map(tuple, blobs.gen_blobs(spark, 500, 4, parts=1).collect()))
    many = sorted(map(tuple, blobs.gen_blobs(spark, 500, 4, parts=7, shuffle=True).collect()))
    assert one == many
    assert one != sorted(map(tuple, blobs.gen_blobs(spark, 500, 4, seed=1).collect()))


def test_blobs_lie_around_their_centers(spark):
    rows = blobs.gen_blobs(spark, 20_000, 1)
    a, b = [rows.where(F.col("label") == s).agg(F.avg("x"), F.avg("y"), F.stddev("x")).first() for s in "AB"]
    assert abs(a[2] - 3) < 0.2 and abs(b[2] - 3) < 0.2
    assert abs(b[0] - a[0] - 5) < 0.3 and abs(b[1] - a[1] - 5) < 0.3


def test_draws_and_salts(spark):
    df = spark.range(5000).select(uniform_pair(1, "s", F.col("id")).alias("p"), salt(8, F.col("id")).alias("salt"))
    low, high, avg, salts = df.agg(
        F.min("p.u"), F.max("p.v"), F.avg("p.u"), F.count_distinct("salt")
    ).first()
    assert 0 < low and high < 1 and abs(avg - 0.5) < 0.03 and salts == 8
