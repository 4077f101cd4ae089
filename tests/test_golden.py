"""Values that were computed once, apart from this library, on the tables at scale 0.01."""

import os

import pytest
from pyspark.sql import functions as F

from pointflow.operators import batches, kmeans, words
from pointflow.plans import bindings as b

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


def test_lloyd(spark):
    want = [
        (7.0359825769, 4.9933716306),
        (20.0100697134, 4.9969016266),
        (32.9224344448, 4.9387504047),
        (44.9398729390, 5.0461352292),
    ]
    for got, center in zip(kmeans.lloyd(b.points2(spark, FOLDER), b.CENTERS, 3), want):
        assert got == pytest.approx(center, abs=1e-9)


def test_words(spark):
    row = words.wordcount_summary(b.doc_lines(spark, FOLDER)).first()
    assert tuple(row)[:3] == (9344, 390171, 93796)
    assert row["avg_length"] == pytest.approx(7.777058723, abs=1e-9)


@pytest.mark.parametrize("seconds, processed, taken", [(86_400, 2660, 8), (600, 2500, None)])
def test_threshold(spark, seconds, processed, taken):
    items = b.table(spark, FOLDER, "events").select(
        batches.batch_number("ts", seconds).alias("batch"), F.col("user_id").alias("item")
    )
    kept = batches.taken_until(items, 2500)
    assert tuple(batches.item_summary(kept).first()) == (processed, 150, 149)
    if taken:
        assert kept.select("batch").distinct().count() == taken
