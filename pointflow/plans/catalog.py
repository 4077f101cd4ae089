"""One entry per operator: `name -> (spark, folder) -> DataFrame`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointflow.functions import text, vectors
from pointflow.operators import (
    assign,
    batches,
    bounded_lloyd,
    center_blocks,
    fair,
    keyed_lloyd,
    kmeans,
    metrics,
    partials,
    words,
)
from pointflow.plans import bindings as b
from pointflow.session import scratch_folder
from pointflow.sources import blobs, items, points
from pointflow.streaming import distinct, faults, running

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def xy(column: str = "point", *names: str):
    return [F.round(F.col(column)[j], DIGITS).alias(n) for j, n in enumerate(names or ("x", "y"))]


def rounded(*names: str):
    return [F.round(n, DIGITS).alias(n) for n in names]


def center_rows(spark: SparkSession, centers: assign.Centers) -> DataFrame:
    return assign.centers_frame(spark, centers).select("k", *xy("center"))


# --- sources and sinks


@query
def scan_lines(spark, folder):
    path = scratch_folder(spark, "lines")
    b.point_lines(spark, folder).write.text(path)
    return points.read_lines(spark, path)


@query
def parse_points(spark, folder):
    parsed = points.parse_points(b.point_lines(spark, folder, tax=True))
    return parsed.select(*xy("point", "x", "y", "z"), "label", "grp")


@query
def parse_points_2d(spark, folder):
    return points.parse_points_2d(b.point_lines(spark, folder)).select(*xy(), "grp")


@query
def split_groups(spark, folder):
    parts = points.split_groups(b.ab_lines(spark, folder))
    sums = [F.round(F.sum(F.col("point")[j]), 4).alias(n) for j, n in enumerate(("sum_x", "sum_y"))]
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *sums)


@query
def repartition_load(spark, folder):
    spread = points.load_parts(b.point_lines(spark, folder), 8)
    return spread.select(F.spark_partition_id().alias("part"), F.length("value").alias("size")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_chars"), F.count_distinct("part").alias("n_parts")
    )


def _order_blobs(spark, folder, shuffle=False):
    """A point for every order; order keys count from 0."""
    orders = b.table(spark, folder, "orders")
    ids = orders.select(F.col("o_orderkey").alias("id"))
    return blobs.place_blobs(ids, orders.count(), b.BLOBS, shuffle=shuffle)


@query
def gen_blobs(spark, folder):
    return _order_blobs(spark, folder)


@query
def gen_blobs_shuffled(spark, folder):
    return _order_blobs(spark, folder, shuffle=True)


@query
def gen_blob_sizes(spark, folder):
    return _order_blobs(spark, folder).groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def points_csv_roundtrip(spark, folder):
    path = scratch_folder(spark, "points")
    points.write_points(b.points2(spark, folder, F.col("l_returnflag").alias("label")), path)
    return points.parse_points(points.read_lines(spark, path), dims=2).select(*xy(), "label", "grp")


@query
def points_csv_odd_labels(spark, folder):
    """Labels with blanks and quotes, which a text line carries as they are."""
    flag = F.col("l_returnflag")
    label = F.when(flag == "A", " A").when(flag == "N", 'q"N ').otherwise(flag).alias("label")
    path = scratch_folder(spark, "points")
    points.write_points(b.points2(spark, folder, label), path)
    return points.parse_points(points.read_lines(spark, path), dims=2).select(*xy(), "label", "grp")


@query
def sample_head(spark, folder):
    return points.sample_head(b.table(spark, folder, "events").select("event_id", "user_id"), 10, "event_id")


@query
def encode_group(spark, folder):
    rows = b.table(spark, folder, "lineitem")
    grp = points.encode_group(F.col("l_returnflag")).alias("grp")
    return rows.groupBy(F.col("l_returnflag").alias("label"), grp).agg(F.count(F.lit(1)).alias("n"))


@query
def filter_suffix(spark, folder):
    return points.filter_suffix(b.point_lines(spark, folder), "A")


@query
def group_counts(spark, folder):
    return points.group_counts(b.point_lines(spark, folder))


# --- assignment and objectives


@query
def assign_nearest(spark, folder):
    return assign.assign_nearest(b.points2(spark, folder), b.CENTERS).select(*xy(), "grp", "k", *rounded("dist2"))


@query
def assign_nearest_wide(spark, folder):
    near = assign.assign_nearest(b.points64(spark, folder), b.centers64(spark, folder))
    return near.select("vec_id", "k", *rounded("dist2"))


@query
def nearest_index(spark, folder):
    return assign.nearest_index(b.points2(spark, folder), b.CENTERS).select(*xy(), "k")


@query
def nearest_dist2(spark, folder):
    return assign.nearest_dist2(b.points2(spark, folder), b.CENTERS).select(*xy(), *rounded("dist2"))


def _assigned(spark, folder, *keep):
    return assign.assign_nearest(b.points2(spark, folder, *keep), b.CENTERS)


@query
def standard_objective(spark, folder):
    return metrics.standard_objective(_assigned(spark, folder)).select(*rounded("delta"))


@query
def fair_objective(spark, folder):
    return metrics.fair_objective(_assigned(spark, folder)).select(*rounded("phi_a", "phi_b", "phi"))


@query
def cluster_group_counts(spark, folder):
    # one center is far from all points, so that an empty cluster shows
    centers = [*b.CENTERS, [1e6, 1e6]]
    near = assign.assign_nearest(b.points2(spark, folder), centers)
    return metrics.cluster_group_counts(near, len(centers))


def _report_columns():
    return ["k", *xy("center"), "n_a_k", "n_b_k", "n", "n_a", "n_b", *rounded("delta", "phi_a", "phi_b", "phi")]


@query
def cluster_report(spark, folder):
    return metrics.cluster_report(b.points2(spark, folder), b.CENTERS).select(*_report_columns())


@query
def cluster_report_by_segment(spark, folder):
    rows = b.points2(spark, folder, F.col("l_linestatus").alias("segment"))
    return metrics.cluster_report(rows, b.CENTERS, by=["segment"]).select("segment", *_report_columns())


def _nullable_points(spark, folder):
    """Line items without the rows whose discount is missing; every tenth order has none."""
    rows = b.table(spark, folder, "lineitem")
    rows = rows.withColumn("l_discount", F.when(F.col("l_orderkey") % 10 != 0, F.col("l_discount")))
    cells = ["l_quantity", F.col("l_discount") * 100]
    return points.points_from_columns(rows.where("l_discount IS NOT NULL"), cells, "l_returnflag")


@query
def assign_nearest_nullable(spark, folder):
    near = assign.assign_nearest(_nullable_points(spark, folder), b.CENTERS)
    return near.groupBy("k", "grp").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("dist2"), 4).alias("ss"))


@query
def assign_many_centers(spark, folder):
    near = center_blocks.assign_nearest_blocks(b.order_points(spark, folder), b.part_centers(spark, folder))
    return near.select("o_orderkey", "k", *rounded("dist2"))


@query
def report_many_centers(spark, folder):
    report = center_blocks.cluster_report_blocks(b.order_points(spark, folder), b.part_centers(spark, folder))
    return report.select(*_report_columns())


# --- sums, means, scatter


@query
def cluster_group_sums(spark, folder):
    sums = partials.cluster_group_sums(b.points2(spark, folder), b.CENTERS)
    cells = [F.round(F.col("sum")[j], 4).alias(n) for j, n in enumerate(("sum_x", "sum_y"))]
    return sums.select("k", "grp", "n", *cells, F.round("ss", 4).alias("ss"))


@query
def cluster_group_means(spark, folder):
    sums = partials.cluster_group_sums(b.points2(spark, folder), b.CENTERS)
    return partials.cluster_group_means(sums).select("k", "grp", "n", *xy("mean"))


@query
def cluster_group_means_wide(spark, folder):
    sums = partials.cluster_group_sums(b.points64(spark, folder), b.centers64(spark, folder))
    cells = partials.cluster_group_means(sums).select("k", "grp", "n", F.posexplode("mean").alias("j", "mean"))
    return cells.select("k", "grp", "n", "j", *rounded("mean"))


@query
def mean_vector(spark, folder):
    rows = b.points2(spark, folder, F.col("l_linestatus").alias("segment"))
    return partials.mean_vector(rows, dims=2, by=["segment"]).select("segment", "n", *xy("mean"))


def _models(spark, folder, by=(), selection="population"):
    rows = b.points2(spark, folder, *[F.col("l_suppkey").alias(c) for c in by])
    sums = partials.cluster_group_sums(rows, b.CENTERS, by, moments=True)
    return fair.fair_models(sums, b.CENTERS, by, selection)


@query
def cluster_shares(spark, folder):
    return fair.fair_stats(_models(spark, folder)).select("k", *rounded("alpha", "beta"))


@query
def group_mean_gap(spark, folder):
    return fair.fair_stats(_models(spark, folder)).select("k", *rounded("ell"))


@query
def group_scatter(spark, folder):
    sums = partials.cluster_group_sums(b.points2(spark, folder), b.CENTERS, moments=True)
    return fair.group_scatter(sums, b.CENTERS).select(*rounded("delta_a", "delta_b"))


@query
def group_scatter_offset(spark, folder):
    """Points a million away from the only center, per line status, by generated code and by Arrow."""
    rows = b.points2(spark, folder, F.col("l_linestatus").alias("segment"))
    rows = rows.withColumn("point", F.transform("point", lambda v: v + b.OFFSET))
    found = []
    for strategy in ("unrolled", "arrow"):
        sums = partials.cluster_group_sums(rows, [[0.0, 0.0]], ["segment"], strategy, moments=True)
        scatter = fair.group_scatter(sums, [[0.0, 0.0]], ["segment"])
        found.append(scatter.select("segment", F.lit(strategy).alias("strategy"), *rounded("delta_a", "delta_b")))
    return found[0].union(found[1])


# --- k-means and fair centers


@query
def kmeans_fit(spark, folder):
    return center_rows(spark, kmeans.kmeans_fit(b.points2(spark, folder), 4, 20))


@query
def kmeans_init(spark, folder):
    return center_rows(spark, kmeans.kmeans_init(b.points2(spark, folder), 4))


@query
def lloyd_rounds(spark, folder):
    return center_rows(spark, kmeans.lloyd(b.points2(spark, folder), b.CENTERS, b.LLOYD_ROUNDS))


@query
def lloyd_bounded(spark, folder):
    centers, _ = bounded_lloyd.lloyd_bounded(b.points2(spark, folder), b.CENTERS, b.BOUNDED_ROUNDS)
    return center_rows(spark, centers)


@query
def lloyd_by_segment(spark, folder):
    rows = b.points2(spark, folder, F.col("l_suppkey").alias("segment"))
    found = keyed_lloyd.lloyd_by(rows, b.supplier_centers(spark, folder), ["segment"], b.LLOYD_ROUNDS)
    return found.select("segment", "k", *xy("center"))


@query
def fair_stats(spark, folder):
    stats = fair.fair_stats(_models(spark, folder, ["segment"]), ["segment"])
    return stats.select(
        "segment",
        "k",
        "n_a",
        "n_b",
        *rounded("alpha", "beta", "ell"),
        *xy("mean_a", "a_x", "a_y"),
        *xy("mean_b", "b_x", "b_y"),
    )


@query
def fair_line_search(spark, folder):
    searched = fair.fair_line_search(_models(spark, folder, ["segment"]))
    return fair.fair_centroids(searched, ["segment"]).select("segment", "k", *rounded("x"))


@query
def fair_centroids(spark, folder):
    searched = fair.fair_line_search(_models(spark, folder, ["segment"]))
    return fair.fair_centroids(searched, ["segment"]).select("segment", "k", *xy("center"))


@query
def fair_lloyd(spark, folder):
    return center_rows(spark, fair.fair_lloyd(b.points2(spark, folder), b.CENTERS, b.FAIR_ROUNDS))


@query
def fair_lloyd_population(spark, folder):
    centers = fair.fair_lloyd(b.points2(spark, folder), b.CENTERS, b.FAIR_ROUNDS, "population")
    return center_rows(spark, centers)


@query
def fair_lloyd_auto(spark, folder):
    return center_rows(spark, fair.fair_lloyd(b.points2(spark, folder), k=4, rounds=b.FAIR_ROUNDS))


def _far_points(spark, folder):
    """Line items at seven far places, one per line number, group A being return flag A.

    With as many centers as places every good start finds all of them.
    """
    rows = b.table(spark, folder, "lineitem")
    number = F.col("l_linenumber").cast("double")
    return points.points_from_columns(rows, [number * 1000, number * number * 100], "l_returnflag")


def _sorted_centers(spark, centers):
    rows = sorted(map(tuple, centers))
    return center_rows(spark, [list(r) for r in rows])


@query
def kmeans_fit_far(spark, folder):
    return _sorted_centers(spark, kmeans.kmeans_fit(_far_points(spark, folder), 7, 20))


@query
def kmeans_init_far(spark, folder):
    return _sorted_centers(spark, kmeans.kmeans_init(_far_points(spark, folder), 7))


@query
def fair_lloyd_auto_far(spark, folder):
    return _sorted_centers(spark, fair.fair_lloyd(_far_points(spark, folder), k=7, rounds=b.FAIR_ROUNDS))


@query
def kmeans_fit_facts(spark, folder):
    """What holds for any start: centers found, points in all clusters, and the objective."""
    rows = _far_points(spark, folder)
    centers = kmeans.kmeans_fit(rows, 12, 20)
    report = metrics.cluster_report(rows, centers)
    return report.groupBy().agg(
        F.lit(12).alias("k"),
        F.lit(kmeans.k_effective(centers)).alias("k_effective"),
        F.sum(F.col("n_a_k") + F.col("n_b_k")).alias("n"),
        F.round(F.max("delta"), DIGITS).alias("delta"),
    )


@query
def fair_report(spark, folder):
    rows = b.points2(spark, folder)
    models = {
        "standard": kmeans.lloyd(rows, b.CENTERS, b.FAIR_ROUNDS),
        "fair": fair.fair_lloyd(rows, b.CENTERS, b.FAIR_ROUNDS),
    }
    report = metrics.compare_centers(rows, models)
    return report.select("model", "n", "n_a", "n_b", *rounded("delta", "phi_a", "phi_b", "phi"))


# --- vectors


@query
def sqdist(spark, folder):
    rows = b.table(spark, folder, "lineitem")
    p = F.array("l_quantity", F.col("l_discount") * 100)
    q = F.array(F.col("l_linenumber").cast("double"), F.col("l_tax") * 100)
    return rows.select(
        "l_orderkey",
        F.round(vectors.sqdist(p, q), DIGITS).alias("d2"),
        F.round(vectors.distance(p, q), DIGITS).alias("d"),
    )


@query
def vector_add_scale(spark, folder):
    rows = b.points2(spark, folder, "l_orderkey", (F.col("l_tax") * 10).alias("t"))
    q = F.array(F.lit(1.5), F.lit(-2.0))
    p = F.col("point")
    return rows.select(
        "l_orderkey",
        vectors.add(p, q).alias("total"),
        vectors.scale(p, F.col("t")).alias("scaled"),
        vectors.blend(p, q, F.col("t"), F.lit(2.0)).alias("blended"),
        vectors.add(p, vectors.zeros(2)).alias("same"),
    ).select(
        "l_orderkey",
        *[c for v in ("total", "scaled", "blended", "same") for c in xy(v, f"{v}_x", f"{v}_y")],
    )


# --- words


@query
def tokenize_(spark, folder):
    tokens = text.tokenize(F.col("value"))
    return b.doc_lines(spark, folder).select(
        *b.LINE_KEYS, F.size(tokens).alias("n_tokens"), F.array_join(tokens, "|").alias("joined")
    )


@query
def word_count(spark, folder):
    return words.word_count(b.doc_lines(spark, folder))


@query
def word_count_salted(spark, folder):
    return words.word_count_salted(b.doc_lines(spark, folder), b.LINE_KEYS, salts=8, salt_from="pair")


@query
def word_count_salted_groupby(spark, folder):
    return words.word_count_salted(b.doc_lines(spark, folder), b.LINE_KEYS, salts=8, salt_from="word_doc")


@query
def word_count_salted_hot(spark, folder):
    return words.word_count_salted_hot(b.doc_lines(spark, folder))


@query
def word_count_by_partition(spark, folder):
    return words.word_count_by_partition(b.doc_lines(spark, folder), parts=8)


@query
def doc_word_count(spark, folder):
    return words.doc_word_count(b.doc_lines(spark, folder), b.LINE_KEYS)


@query
def distinct_words(spark, folder):
    return words.distinct_words(words.words(b.doc_lines(spark, folder)))


@query
def avg_word_length(spark, folder):
    return words.avg_word_length(words.word_count(b.doc_lines(spark, folder))).select(*rounded("avg_length"))


@query
def wordcount_summary(spark, folder):
    summary = words.wordcount_summary(b.doc_lines(spark, folder))
    return summary.select("n_docs", "n_tokens", "n_words", *rounded("avg_length"))


@query
def word_length_(spark, folder):
    return words.word_count(b.doc_lines(spark, folder)).select(
        "word",
        text.word_length(F.col("word")).alias("points"),
        text.word_length(F.col("word"), utf16=True).alias("units"),
    )


# --- items and streams


@query
def parse_items(spark, folder):
    # clicks get a leading blank, which is not part of a number
    blank = F.when(F.col("event_type") == "click", " ").otherwise("")
    lines = b.table(spark, folder, "events").select(
        "event_id", F.concat(blank, F.col("user_id").cast("string")).alias("value")
    )
    return items.parse_items(lines, on_bad="drop")


@query
def batch_distinct(spark, folder):
    return batches.batch_distinct(b.event_items(spark, folder))


@query
def batch_sizes(spark, folder):
    return batches.running_before(batches.batch_sizes(b.event_items(spark, folder)))


@query
def distinct_union(spark, folder):
    users = b.table(spark, folder, "events").select(F.col("user_id").alias("item"))
    buyers = b.table(spark, folder, "orders").select(F.col("o_custkey").alias("item"))
    return batches.distinct_union(users, buyers)


@query
def largest_item(spark, folder):
    return batches.largest_item(b.event_items(spark, folder))


@query
def stream_summary(spark, folder):
    return batches.item_summary(b.event_items(spark, folder))


@query
def stream_threshold_replay(spark, folder):
    taken = batches.taken_events(b.table(spark, folder, "events"), b.THRESHOLD, "ts", b.DAY_SECONDS)
    return batches.item_summary(taken.select(F.col("user_id").alias("item")))


@query
def stream_threshold_batches(spark, folder):
    """The same cut for items that carry a batch number and no time."""
    return batches.item_summary(batches.taken_until(b.event_items(spark, folder), b.THRESHOLD))


def _event_stream(spark, folder):
    lines = items.stream_table(spark, folder, "events").select(F.col("user_id").cast("string").alias("value"))
    return items.parse_items(lines)


@query
def stream_distinct(spark, folder):
    return distinct.drain_distinct(_event_stream(spark, folder), scratch_folder(spark, "distinct"))


@query
def stream_batches(spark, folder):
    return distinct.run_batches(_event_stream(spark, folder), scratch_folder(spark, "batches")).summary()


def _live_items(spark, folder):
    stream, n, step = b.live_events(spark, folder, "user_id")
    return items.parse_items(stream.select(F.col("user_id").cast("string").alias("value"))), n, step


@query
def stream_threshold_live(spark, folder):
    """A live stream of equal slices, stopped by its threshold: the crossing batch counts whole."""
    parsed, n, _ = _live_items(spark, folder)
    threshold = max(1, -(-n // b.LIVE_SHARE))
    tables = distinct.run_batches(parsed, scratch_folder(spark, "batches"), threshold, interval=distinct.BATCH_INTERVAL)
    return tables.summary().select("processed", tables.sizes().agg(F.count("*")).scalar().alias("n_batches"))


@query
def stream_empty_batches(spark, folder):
    """Every other slice loses all its items: such a batch has a number, but no size, and moves no total."""
    stream, _, step = b.live_events(spark, folder, "event_id", "user_id")
    even = F.floor(F.col("event_id") / step) % 2 == 0
    taken = stream.where(even).select(F.col("user_id").alias("item"))
    tables = distinct.run_batches(taken, scratch_folder(spark, "batches"), interval=distinct.BATCH_INTERVAL)
    empty = tables.empty_batches().agg(F.count("*")).scalar()
    return tables.log().select("batch_id", "n", "seen", empty.alias("n_empty"))


@query
def stream_batches_replayed(spark, folder):
    """A batch that came twice in part and one that came twice whole, after restarts from the checkpoint."""
    parsed, _, _ = _live_items(spark, folder)
    broken = faults.Faults([("items", 1), ("mark", 2)])
    tables = faults.run_through(parsed, scratch_folder(spark, "batches"), broken)
    return tables.summary().select(
        "*",
        tables.sizes().agg(F.count("*")).scalar().alias("n_batches"),
        F.lit(len(broken.raised)).alias("n_faults"),
        F.lit(len(broken.delivered)).cast("bigint").alias("n_delivered"),
    )


@query
def stream_running_distinct(spark, folder):
    """How many items each slice brought that were not seen before, and all up to it."""
    stream, _, step = b.live_events(spark, folder, "event_id", "user_id")
    numbered = stream.select(F.col("user_id").alias("item"), F.floor(F.col("event_id") / step).alias("batch"))
    return running.running_distinct(numbered, scratch_folder(spark, "running"))
