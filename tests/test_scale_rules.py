"""Input that is missing, ragged or late, and plans that must stay linear."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pointflow import scratch_folder
from pointflow.__main__ import main
from pointflow.operators import assign, batches, kmeans, metrics, partials, words
from pointflow.plans import programs
from pointflow.sources import items, points
from pointflow.sources.items import stream_table
from pointflow.streaming import distinct

POINTS = "point array<double>, grp int"
# K * D on both sides of the switch between the forms, which all must agree
SIZES = [(12, 2), (13, 2), (5, 5)]


def centers(k, dims):
    return [[float(i + j) for j in range(dims)] for i in range(k)]


@pytest.mark.parametrize("k, dims", SIZES)
@pytest.mark.parametrize("strategy", ["unrolled", "lambda", "arrow"])
def test_all_forms_refuse_the_same_points(spark, k, dims, strategy):
    whole = [1.0] * dims
    for bad in ([None, *whole[1:]], None, whole[1:], [*whole, 1.0]):
        frame = spark.createDataFrame([(whole, 0), (bad, 1)], POINTS)
        with pytest.raises(PySparkException, match="a point"):
            assign.assign_nearest(frame, centers(k, dims), strategy).collect()
        with pytest.raises(PySparkException, match="a point"):
            partials.cluster_group_sums(frame, centers(k, dims), strategy=strategy).collect()
    nan = spark.createDataFrame([([float("nan"), *whole[1:]], 0)], POINTS)
    row = assign.assign_nearest(nan, centers(k, dims), strategy).first()
    assert row["k"] == 0 and row["dist2"] != row["dist2"]


@pytest.mark.parametrize("k, dims", SIZES)
@pytest.mark.parametrize("grp", [2, -1, None])
def test_other_groups_are_refused_at_every_size(spark, k, dims, grp):
    frame = spark.createDataFrame([([1.0] * dims, grp)], POINTS)
    for strategy in ("unrolled", "lambda", "arrow"):
        with pytest.raises(PySparkException, match="grp must be 0 or 1"):
            partials.cluster_group_sums(frame, centers(k, dims), strategy=strategy).collect()
    with pytest.raises(PySparkException, match="grp must be 0 or 1"):
        metrics.cluster_report(frame, centers(k, dims)).collect()


def test_user_columns_do_not_clash(spark):
    frame = spark.createDataFrame([([1.0, 2.0], 0, "c", "k", "d")], POINTS + ", _c string, _k string, _d0 string")
    row = assign.assign_nearest(frame, [[0.0, 0.0], [1.0, 2.0]], "unrolled").first()
    assert (row["k"], row["_c"], row["_k"], row["_d0"]) == (1, "c", "k", "d")


@pytest.mark.parametrize("on_bad", ["fail", "drop"])
def test_parsing_keeps_underscore_columns(spark, on_bad):
    frame = spark.createDataFrame([("1,2,A", "s", "f")], "value string, _src string, _fields string")
    for parsed in (points.parse_points(frame, on_bad=on_bad), points.parse_points_2d(frame, on_bad)):
        assert parsed.columns[:2] == ["_src", "_fields"] and parsed.first()["_src"] == "s"
    numbers = spark.createDataFrame([("7", "s")], "value string, _item string")
    assert items.parse_items(numbers, on_bad).columns == ["_item", "item"]


def test_width_of_the_first_line(spark):
    frame = spark.createDataFrame([("",), ("1,2,A",), ("1,2,3,A",)], "value string").coalesce(1)
    assert points.parse_points(frame, "first", "drop").count() == 1
    with pytest.raises(PySparkException, match="bad line"):
        points.parse_points(frame.where("value <> ''"), "first").collect()


def test_an_item_has_no_line_end(spark):
    assert items.parse_items(spark.createDataFrame([("7\n",), ("7",)], "value string"), "drop").count() == 1


@pytest.mark.parametrize("dims", [2, partials.WIDE_DIMS + 1])
def test_mean_vector_at_any_width(spark, dims):
    frame = lambda *rows: spark.createDataFrame([(r,) for r in rows], "point array<double>")
    ones, twos = [1.0] * dims, [3.0] * dims
    assert tuple(partials.mean_vector(frame(ones, twos)).first()) == (2, [2.0] * dims)
    assert [tuple(r) for r in partials.mean_vector(frame(), dims).collect()] == [(0, None)]
    for bad in (ones[1:], None, [None, *ones[1:]]):
        with pytest.raises(PySparkException, match="a point"):
            partials.mean_vector(frame(ones, bad), dims).collect()
    by = spark.createDataFrame([("a", ones), ("b", twos), ("a", twos)], "s string, point array<double>")
    got = {r["s"]: (r["n"], r["mean"][0]) for r in partials.mean_vector(by, dims, ["s"]).collect()}
    assert got == {"a": (2, 2.0), "b": (1, 3.0)}


def test_point_files_carry_labels_or_refuse_them(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame(list(rows), "point array<double>, label string")
    odd = [" A", "A ", 'q"A', "it's", "é"]
    points.write_points(frame(*[([1.0, 2.0], o) for o in odd]), str(tmp_path / "odd"))
    back = points.parse_points(points.read_lines(spark, str(tmp_path / "odd")), 2)
    assert sorted(r["label"] for r in back.collect()) == sorted(odd)
    bad = [([1.0], "A"), ([1.0, 2.0, 3.0], "A"), ([1.0, None], "A"), ([1.0, float("nan")], "A"), (None, "A")]
    bad += [([1.0, 2.0], x) for x in ("", None, "a,b", "a\nb", "a\r")]
    for i, row in enumerate(bad):
        with pytest.raises(PySparkException):
            points.write_points(frame(([1.0, 2.0], "A"), row), str(tmp_path / f"bad{i}"), dims=2)


def test_reports_are_linear_in_clusters(spark):
    many = [[float(i), 0.0] for i in range(20_000)]
    near = spark.range(100).select(
        (F.col("id") * 7).cast("int").alias("k"), F.lit(1.0).alias("dist2"), (F.col("id") % 2).cast("int").alias("grp")
    )
    counts = metrics.cluster_group_counts(near, len(many))
    text = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in text and text.count("Range (") == 1
    assert counts.agg(F.count("*"), F.sum("n_a"), F.sum("n_b")).first() == (20_000, 50, 50)


def test_items_without_a_batch(spark):
    frame = spark.createDataFrame([(None, 1), (1, 2), (2, 3), (2**62, 4), (-(2**62), 5)], "batch bigint, item bigint")
    got = {r["batch"]: r["n_before"] for r in batches.running_before(batches.batch_sizes(frame)).collect()}
    assert got == {-(2**62): 0, 1: 1, 2: 2, 2**62: 3}
    assert sorted(r["item"] for r in batches.taken_until(frame.where("batch IS NULL OR batch < 9 AND batch > 0"), 2).collect()) == [2, 3]


def test_late_rows_do_not_take_items_along(spark, tmp_path):
    folder = str(tmp_path / "in")

    def put(*rows):
        frame = spark.createDataFrame(list(rows), "item bigint, s string").select("item", F.to_timestamp("s").alias("ts"))
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/t.parquet")

    put((1, "2024-01-01 05:00:00"))
    put((2, "2024-01-01 05:05:00"))
    put((3, "2024-01-01 05:09:00"))
    put((9, "2024-01-01 01:00:00"), (9, "2024-01-01 05:10:00"), (8, "2024-01-01 01:00:00"))
    stream = stream_table(spark, folder, "t", files_per_batch=1)

    def drained(frame):
        path = scratch_folder(spark, "t")
        sink = frame.writeStream.format("parquet").option("checkpointLocation", f"{path}/c").trigger(availableNow=True)
        sink.start(f"{path}/o").awaitTermination()
        return sorted(r["item"] for r in spark.read.parquet(f"{path}/o").collect())

    plain = stream.withWatermark("ts", "1 minute").dropDuplicatesWithinWatermark(["item"])
    assert drained(distinct.stream_distinct(stream, within="1 minute", event_time="ts")) == drained(plain) == [1, 2, 3, 9]


def test_a_stream_without_batches(spark):
    tables = distinct.BatchTables(spark, scratch_folder(spark, "t"))
    assert tuple(tables.summary().first()) == (0, 0, None) and tables.sizes().count() == 0


def test_a_lower_threshold_clears_what_it_does_not_take(spark):
    tables = distinct.BatchTables(spark, scratch_folder(spark, "t"))
    part = lambda *values: spark.createDataFrame([(v,) for v in values], "item bigint")
    tables.write(part(1, 2), 0, 10)
    tables.write(part(3, 4), 1, 10)
    assert tables.summary().first()["processed"] == 4
    tables.write(part(3, 4), 1, 2)
    assert tables.summary().first()["processed"] == tables.sizes().agg(F.sum("n")).first()[0] == 2
    assert tables.log().columns == ["batch_id", "at", "n", "seen"]


def test_closed_batches_are_merged(spark, monkeypatch):
    monkeypatch.setattr(distinct, "MERGE_EVERY", 3)
    tables = distinct.BatchTables(spark, scratch_folder(spark, "t"))
    part = lambda *values: spark.createDataFrame([(v,) for v in values], "item bigint")
    for number in range(8):
        assert tables.write(part(number % 2, 5), number) == 2 * (number + 1)
    for number in (6, 7):
        assert tables.write(part(number % 2, 5), number) == 2 * (number + 1)
    assert tuple(tables.summary().first()) == (16, 3, 5)
    assert [tuple(r) for r in tables.sizes().orderBy("batch_id").collect()] == [(i, 2) for i in range(8)]
    # what a broken merge left behind does not count twice
    part(1, 1).groupBy("item").agg(F.count("*").alias("cnt")).write.parquet(f"{tables.folder}/items/batch_id=1")
    assert tables.summary().first()["processed"] == 16


def test_distinct_program_goes_on(spark, tmp_path):
    for i in range(3):
        spark.range(10 * i, 10 * i + 10).select(F.col("id").cast("string")).coalesce(1).write.mode("append").text(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    first = programs.distinct_report(spark, str(tmp_path / "in"), 10, folder=out)
    assert first["summary"].first()["processed"] == 10
    again = programs.distinct_report(spark, str(tmp_path / "in"), 1000, folder=out)
    assert again["summary"].first()["processed"] >= 20


def test_salting_pairs_counts_alike(spark):
    lines = spark.createDataFrame([(1, "a b a"), (2, "a  c"), (3, "")], "doc_id bigint, value string")
    count = lambda df: sorted(map(tuple, df.collect()))
    plain = count(words.word_count(lines))
    for how in words.SALT_SOURCES:
        assert count(words.word_count_salted(lines, ["doc_id"], 4, how)) == plain


def test_center_tables_are_checked(spark, monkeypatch):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (0, [3.0, 4.0])], "k int, center array<double>")
    assert assign.collect_centers(frame) == [[3.0, 4.0], [1.0, 2.0]]
    monkeypatch.setattr(assign, "MAX_CENTER_BYTES", 24)
    with pytest.raises(ValueError, match="too large"):
        assign.collect_centers(frame)


def test_the_command_line_writes_all_rows(spark, tmp_path, capsys):
    path = tmp_path / "words.txt"
    path.write_text(" ".join(f"w{i}" for i in range(150)) + "\n")
    main(["words", str(path), "--out", str(tmp_path / "out")])
    assert spark.read.json(str(tmp_path / "out" / "counts")).count() == 150
    main(["words", str(path), "--rows", "5"])
    assert "5 of 150 rows" in capsys.readouterr().out
    text = tmp_path / "points.txt"
    text.write_text("0,0,A\n9,9,B\n0,0,B\n")
    main(["clusters", str(text), "4", "3", "--out", str(tmp_path / "fit")])
    fit = [json.loads(x["value"]) for x in spark.read.text(str(tmp_path / "fit" / "fit")).collect()]
    assert fit == [{"k": 4, "k_effective": 2}] and kmeans.k_effective([[0.0]]) == 1
