"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from pointflow.operators import assign, batches, fair, metrics, partials, words

CENTERS = [[0.0, 0.0], [1.0, 1.0]]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|round|single)", plan(df), re.I))


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(10).select(
        F.array(F.col("id").cast("double"), F.lit(1.0)).alias("point"), (F.col("id") % 2).cast("int").alias("grp")
    )


@pytest.fixture(scope="module")
def lines(spark):
    return spark.range(10).select(F.col("id").alias("doc_id"), F.lit(0).alias("line"), F.lit("a b").alias("value"))


def test_assignment_neither_shuffles_nor_joins(points):
    for strategy in ("unrolled", "lambda", "arrow"):
        text = plan(assign.assign_nearest(points, CENTERS, strategy))
        assert "Exchange" not in text and not any(f in text for f in FORBIDDEN)
        assert ("Arrow" in text or "Python" in text) == (strategy == "arrow")


def test_one_shuffle_per_round(points):
    assert exchanges(partials.cluster_group_sums(points, CENTERS)) == 1
    wide = partials.cluster_group_sums(points, [[float(i), 0.0] for i in range(40)])
    assert exchanges(wide) == 1 and "MapInArrow" in plan(wide)


def test_a_fair_round_has_two_shuffles(points):
    sums = partials.cluster_group_sums(points, CENTERS)
    for selection in fair.SELECTIONS:
        chosen = fair.fair_centroids(fair.fair_line_search(fair.fair_models(sums, CENTERS, selection=selection)))
        assert exchanges(chosen) == 2


def test_the_code_of_a_round_does_not_depend_on_the_centers(points):
    one, two = (
        re.sub(r"#\d+L?|plan_id=\d+|id=#\d+|\[c\]", "", plan(partials.cluster_group_sums(points, c)))
        for c in (CENTERS, [[3.5, 4.5], [6.5, 7.5]])
    )
    assert one == two


def test_report_is_one_pass(points):
    text = plan(metrics.cluster_report(points, CENTERS))
    assert text.count("Range (") == 1 and not any(f in text for f in FORBIDDEN)
    assert plan(metrics.compare_centers(points, {"a": CENTERS, "b": [[2.0, 2.0]]})).count("Range (") == 1


def test_word_shuffles(lines):
    assert exchanges(words.word_count(lines)) == 1
    assert exchanges(words.word_count_by_partition(lines)) == 1
    assert exchanges(words.word_count_salted(lines, ["doc_id", "line"])) == 2
    assert exchanges(words.doc_word_count(lines, ["doc_id", "line"])) == 0
    assert "partial_count" in plan(words.word_count(lines))


def test_batch_sizes_are_computed_once(spark):
    items = spark.range(100).select((F.col("id") % 9).alias("batch"), F.col("id").alias("item"))
    df = batches.taken_until(items, 40)
    df.collect()
    text = plan(df)
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and not any(f in text for f in FORBIDDEN)


def test_only_the_needed_columns_are_read(spark):
    path = "/root/testdata/sf0.001/lineitem.parquet"
    from pointflow.sources.points import points_from_columns

    df = points_from_columns(spark.read.parquet(path), ["l_quantity", "l_discount"], "l_returnflag")
    text = plan(metrics.cluster_report(df, CENTERS))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string>" in text
