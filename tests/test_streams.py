import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pointflow import scratch_folder
from pointflow.operators import batches
from pointflow.sources.items import stream_table
from pointflow.streaming import distinct

SCHEMA = "batch bigint, item bigint"


def replay(rows, threshold):
    taken, seen = [], 0
    for number in sorted({b for b, _ in rows}):
        if seen >= threshold:
            break
        members = [i for b, i in rows if b == number]
        taken += members
        seen += len(members)
    return taken


def cloud(numbers, n=600):
    """Items of which a third are one and the same, in batches of which one holds a third of all."""
    draw = random.Random(5)
    pick = lambda many, hot: hot if draw.random() < 0.34 else draw.choice(many)
    return [(pick(numbers, numbers[1]), pick(range(50), 7)) for _ in range(n)]


@pytest.mark.parametrize(
    "numbers", [list(range(20)), [-(2**40), -70_000, -1, 0, 1, 65_535, 65_536, 65_537, 200_000, 2**33, 2**50]]
)
def test_threshold_replay(spark, numbers):
    rows = cloud(numbers)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    sizes = Counter(b for b, _ in rows)
    got = {r["batch"]: (r["n"], r["n_before"]) for r in batches.running_before(batches.batch_sizes(df)).collect()}
    assert got == {b: (n, sum(m for c, m in sizes.items() if c < b)) for b, n in sizes.items()}
    for threshold in (1, 100, 250, 599, 600, 10_000):
        taken = replay(rows, threshold)
        row = batches.item_summary(batches.taken_until(df, threshold)).first()
        assert tuple(row) == (len(taken), len(set(taken)), max(taken))


def test_batch_sets(spark):
    rows = cloud(list(range(6)))
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, batches.batch_distinct(df).collect())) == sorted(set(rows))
    union = batches.distinct_union(df.where("batch < 3"), df.where("batch >= 2"))
    assert sorted(r[0] for r in union.collect()) == sorted({i for _, i in rows})
    assert batches.largest_item(df).first()[0] == max(i for _, i in rows)
    assert tuple(batches.item_summary(df.where("batch > 9")).first()) == (0, 0, None)
    with pytest.raises(ValueError):
        batches.taken_until(df, 0)
    with pytest.raises(ValueError):
        batches.distinct_union()


def test_batch_numbers(spark):
    stamps = ["1970-01-01 00:00:00", "1969-12-31 23:59:59.999999", "2024-01-01 00:09:59.999999", "2024-01-01 00:10:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        batches.batch_number(F.to_timestamp_ntz("s"), 600).alias("b")
    )
    first = 1_704_067_200 // 600
    assert [r["b"] for r in df.collect()] == [0, -1, first, first + 1]


@pytest.fixture
def files(spark, tmp_path):
    """Ten files of a hundred items, in a folder that looks like a table."""
    draw = random.Random(2)
    rows = [(i, 7 if draw.random() < 0.34 else draw.randrange(60)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, item bigint").repartitionByRange(10, "id").select("item")
    folder = str(tmp_path / "in")
    df.write.parquet(f"{folder}/t.parquet")
    return folder, [i for _, i in rows]


def test_drained_stream_equals_the_batch_query(spark, files):
    folder, items = files
    stream = stream_table(spark, folder, "t", files_per_batch=3)
    out = distinct.drain_distinct(stream, scratch_folder(spark, "t"))
    assert sorted(r[0] for r in out.collect()) == sorted(set(items))
    tables = distinct.run_batches(stream, scratch_folder(spark, "t"))
    assert tuple(tables.summary().first()) == (1000, len(set(items)), max(items))
    assert sorted(r["n"] for r in tables.sizes().collect()) == [100, 300, 300, 300]


@pytest.mark.parametrize("interval", [None, "100 milliseconds"])
def test_threshold_takes_the_crossing_batch_whole(spark, files, interval):
    stream = stream_table(spark, files[0], "t", files_per_batch=1)
    tables = distinct.run_batches(stream, scratch_folder(spark, "t"), threshold=250, interval=interval)
    processed, n_distinct, largest = tables.summary().first()
    assert processed == 300 and tables.sizes().count() == 3
    assert n_distinct <= 60 and largest < 60


def test_a_batch_that_comes_twice_counts_once(spark):
    tables = distinct.BatchTables(spark, scratch_folder(spark, "t"))
    first, second = (spark.createDataFrame([(i,) for i in part], "item bigint") for part in ([1, 1, 2], [2, 9]))
    assert tables.write(first, 0, 4) == 3
    assert tables.write(first, 0, 4) == 3
    assert tables.write(second, 1, 4) == 5
    assert tables.write(second, 1, 4) == 5
    assert tables.write(first, 2, 4) == 5
    assert tuple(tables.summary().first()) == (5, 3, 9)
    assert [tuple(r) for r in tables.sizes().orderBy("batch_id").collect()] == [(0, 3), (1, 2)]


def test_a_restarted_query_goes_on_counting(spark, files, tmp_path):
    folder, items = files
    out = scratch_folder(spark, "t")
    stream = stream_table(spark, folder, "t", files_per_batch=2)
    query, tables, reached = distinct.start_batches(stream, out, 350, interval="100 milliseconds")
    assert reached.wait(60)
    query.stop()
    assert tables.summary().first()["processed"] == 400
    again = distinct.run_batches(stream, out, threshold=700)
    assert again.summary().first()["processed"] == 800


def test_repeats_after_the_limit_may_come_again(spark, tmp_path):
    folder = str(tmp_path / "in")
    for minute, item in ((0, 1), (1, 1), (40, 2), (41, 3), (60, 1)):
        row = [(item, f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00")]
        df = spark.createDataFrame(row, "item bigint, s string").select("item", F.to_timestamp("s").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{folder}/t.parquet")
    stream = stream_table(spark, folder, "t", files_per_batch=1)
    out = distinct.stream_distinct(stream, within="10 minutes", event_time="ts")
    path = scratch_folder(spark, "t")
    out.writeStream.format("parquet").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start(
        f"{path}/o"
    ).awaitTermination()
    assert sorted(r["item"] for r in spark.read.parquet(f"{path}/o").collect()) == [1, 1, 2, 3]
    with pytest.raises(ValueError):
        distinct.stream_distinct(stream, within="1 minute")


def test_bad_threshold(spark, files):
    with pytest.raises(ValueError):
        distinct.start_batches(stream_table(spark, files[0], "t"), "x", 0)
