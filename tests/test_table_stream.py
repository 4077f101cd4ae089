"""The table as a stream, faults and restarts, the running set, and the pruned cut."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pointflow import scratch_folder
from pointflow.operators import batches
from pointflow.sources.table_stream import TableReader, table_stream
from pointflow.streaming import distinct, faults, running

LIVE = distinct.BATCH_INTERVAL


@pytest.fixture
def table(spark, tmp_path):
    """A thousand rows in three files of several row groups, a third of them one item."""
    draw = random.Random(2)
    rows = [(i, 7 if draw.random() < 0.34 else draw.randrange(60), datetime(2024, 1, 1) + timedelta(minutes=i), "x") for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, item bigint, ts timestamp_ntz, other string")
    path = str(tmp_path / "t v.parquet")
    df.repartitionByRange(3, "id").sortWithinPartitions("id").write.option("parquet.block.size", 4096).parquet(path)
    return path, rows


def test_slices_cover_the_table_in_order(spark, table):
    path, rows = table
    out = scratch_folder(spark, "t")
    stream = table_stream(spark, path, ["ts", "id"], 130)
    assert stream.columns == ["ts", "id"] and stream.isStreaming
    seen = {}
    query = stream.writeStream.foreachBatch(lambda df, n: seen.update({n: [tuple(r) for r in df.collect()]}))
    query = query.option("checkpointLocation", out).start()
    query.processAllAvailable()
    query.stop()
    assert [len(seen[n]) for n in sorted(seen)] == [130] * 7 + [90]
    assert [sorted(seen[n]) for n in sorted(seen)] == [[(r[2], r[0]) for r in rows[at : at + 130]] for at in range(0, 1000, 130)]
    with pytest.raises(ValueError):
        table_stream(spark, path, rows_per_batch=0)


def test_without_a_slice_size_all_rows_come_at_once(spark, table):
    path, rows = table
    stream = table_stream(spark, path)
    assert stream.schema == spark.read.parquet(path).schema
    tables = distinct.run_batches(stream, scratch_folder(spark, "t"))
    assert [tuple(r) for r in tables.sizes().collect()] == [(0, 1000)]
    assert tables.summary().first()["n_distinct"] == len({r[1] for r in rows})


def test_reader_plans_pieces_and_goes_on_after_a_restart():
    reader = TableReader([("a", 5), ("b", 0), ("c", 7)], "", 4)
    ends = [reader.latestOffset()["row"] for _ in range(4)]
    assert ends == [4, 8, 12, 12]
    pieces = reader.partitions({"row": 3}, {"row": 9})
    assert [(p.path, p.first, p.n) for p in pieces] == [("a", 3, 2), ("c", 0, 4)]
    assert reader.partitions({"row": 4}, {"row": 4}) == []
    again = TableReader([("a", 5), ("c", 7)], "", 4)
    again.partitions({"row": 4}, {"row": 8})
    assert again.latestOffset() == {"row": 12}


def test_a_stopped_stream_goes_on_where_it_was(spark, table):
    path, rows = table
    out = scratch_folder(spark, "t")
    stream = table_stream(spark, path, ["item"], 100)
    first = distinct.run_batches(stream, out, threshold=250, interval=LIVE)
    assert first.summary().first()["processed"] == 300
    again = distinct.run_batches(stream, out, threshold=620, interval=LIVE)
    # batches that ran on before the stop took nothing
    sizes = [r["n"] for r in again.sizes().orderBy("batch_id").collect()]
    assert set(sizes) == {100} and 600 < sum(sizes) <= 700


@pytest.mark.parametrize("at", [[("items", 0)], [("mark", 0)], [("items", 2), ("mark", 2), ("items", 9), ("mark", 9)]])
def test_faults_change_nothing(spark, table, at):
    path, rows = table
    broken = faults.Faults(at)
    tables = faults.run_through(table_stream(spark, path, ["item"], 100), scratch_folder(spark, "t"), broken)
    assert sorted(broken.raised) == sorted(at) and not broken.left
    assert len(broken.delivered) == 10 + len(at)
    assert tuple(tables.summary().first()) == (1000, len({r[1] for r in rows}), max(r[1] for r in rows))
    assert sorted(tuple(r) for r in tables.sizes().collect()) == [(n, 100) for n in range(10)]
    assert sorted(r["seen"] for r in tables.log().collect()) == list(range(100, 1001, 100))


def test_other_errors_are_not_caught(spark, table):
    path, _ = table
    stream = table_stream(spark, path, ["item"], 100).select(F.raise_error(F.lit("odd")).cast("bigint").alias("item"))
    with pytest.raises(Exception, match="odd"):
        faults.run_through(stream, scratch_folder(spark, "t"), faults.Faults([]))
    with pytest.raises(ValueError):
        faults.Faults([("nowhere", 1)])


def test_a_batch_is_two_jobs(spark, table):
    path, _ = table
    tables = distinct.BatchTables(spark, scratch_folder(spark, "t"))
    batch = spark.read.parquet(path).select("item")
    tables.write(batch, 0)
    tracker, spark_context = spark.sparkContext.statusTracker(), spark.sparkContext
    spark_context.setJobGroup("batch", "batch")
    assert tables.write(batch, 1) == 2000
    assert tables.write(batch.where("false"), 2) == 2000
    spark_context.setLocalProperty("spark.jobGroup.id", None)
    # a shuffle that is planned at run time is a job of its own
    assert len(tracker.getJobIdsForGroup("batch")) <= 2 * 3
    assert [r["batch_id"] for r in tables.empty_batches().collect()] == [2]
    assert sorted(r["batch_id"] for r in tables.sizes().collect()) == [0, 1]


def plain_firsts(rows):
    first = {}
    for item, batch in rows:
        first.setdefault(item, batch)
    out, total = {}, 0
    for batch in sorted(set(first.values())):
        new = sum(b == batch for b in first.values())
        total += new
        out[batch] = (new, total)
    return out


def test_running_set(spark, table):
    path, rows = table
    stream = table_stream(spark, path, ["id", "item"], 250).select("item", F.floor(F.col("id") / 50).alias("batch"))
    got = running.running_distinct(stream, scratch_folder(spark, "t")).collect()
    assert {r["batch"]: (r["n_new"], r["n_distinct"]) for r in got} == plain_firsts([(r[1], r[0] // 50) for r in rows])


def _arrivals(spark, folder, parts):
    for rows in parts:
        df = spark.createDataFrame(rows, "item bigint, batch bigint, s string").select("item", "batch", F.to_timestamp("s").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_late_rows_are_not_counted(spark, tmp_path):
    parts = [[(1, 0, "2024-01-01 00:00:00")], [(2, 1, "2024-01-01 05:00:00")], [(3, 2, "2024-01-01 05:01:00")], [(4, 3, "2024-01-01 00:01:00"), (5, 3, "2024-01-01 05:02:00")]]
    stream = _arrivals(spark, str(tmp_path / "in"), parts)
    got = running.running_distinct(stream, scratch_folder(spark, "t"), event_time="ts", within="10 minutes", interval=None)
    assert {r["batch"]: r["n_new"] for r in got.collect()} == {0: 1, 1: 1, 2: 1, 3: 1}
    with pytest.raises(ValueError):
        running.running_distinct(stream, "x", within="10 minutes")


def test_expired_items_are_new_again(spark, tmp_path):
    folder, out = str(tmp_path / "in"), scratch_folder(spark, "t")
    for batch, wait in ((0, 0), (1, 0), (2, 4)):
        time.sleep(wait)
        stream = _arrivals(spark, folder, [[(1, batch, "2024-01-01 00:00:00")]])
        got = running.running_distinct(stream, out, ttl=timedelta(seconds=3), interval=None)
    assert {r["batch"]: r["n_new"] for r in got.collect()} in ({0: 1, 2: 1}, {0: 1, 1: 1, 2: 1})


def replay(rows, threshold, seconds):
    by_batch = {}
    for ident, ts in rows:
        if ts is not None:
            by_batch.setdefault((ts - datetime(1970, 1, 1)) // timedelta(seconds=seconds), []).append(ident)
    taken = []
    for number in sorted(by_batch):
        if len(taken) >= threshold:
            break
        taken += by_batch[number]
    return sorted(taken)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_taken_events(spark, kind):
    draw = random.Random(4)
    days = [datetime(1961, 5, 1), datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2031, 1, 1)]
    stamps = [None if draw.random() < 0.05 else draw.choice(days) + timedelta(seconds=0 if kind == "date" else draw.randrange(9000)) for _ in range(500)]
    rows = list(enumerate(stamps))
    df = spark.createDataFrame([(i, str(t) if t else None) for i, t in rows], "id int, s string").select("id", F.col("s").cast(kind).alias("ts"))
    for seconds in (1, 7, 86_400):
        for threshold in (1, 100, 333, 10_000):
            got = sorted(r["id"] for r in batches.taken_events(df, threshold, "ts", seconds).collect())
            assert got == replay(rows, threshold, seconds)
    assert batches.taken_events(df.where("false"), 5, "ts", 60).count() == 0
    with pytest.raises(ValueError):
        batches.taken_events(df, 0, "ts", 60)


def test_the_cut_is_pushed_to_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    taken = batches.item_summary(batches.taken_events(events, 300, "ts", 86_400).select(F.col("user_id").alias("item")))
    text = taken._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts,2024-01-1" in text.split("PushedFilters")[1].split("ReadSchema")[0]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
