"""How the tables of a folder become points, lines and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointflow.operators.assign import collect_centers
from pointflow.operators.batches import batch_number
from pointflow.operators.words import documents_as_lines
from pointflow.sources.points import points_from_columns
from pointflow.sources.table_stream import table_stream

# the center set that the two-dimensional queries start from
CENTERS = [[5.0, 1.0], [20.0, 9.0], [35.0, 2.0], [45.0, 8.0]]
LLOYD_ROUNDS = 3
FAIR_ROUNDS = 2
BOUNDED_ROUNDS = 8
WIDE_DIMS = 64
# how far the points of the offset query are moved
OFFSET = 1e6
BLOBS = 7
DAY_SECONDS = 86_400
THRESHOLD = 2_500
# slices of the live stream, and the share of its items after which it stops
LIVE_SLICES = 10
LIVE_SHARE = 4
LINE_KEYS = ["doc_id", "line"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def points2(spark: SparkSession, folder: str, *keep) -> DataFrame:
    """Line items as (quantity, discount percent), group A being return flag A."""
    rows = table(spark, folder, "lineitem")
    return points_from_columns(rows, ["l_quantity", F.col("l_discount") * 100], "l_returnflag", *keep)


def points64(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("point"),
        F.when(F.col("label") < 5, 0).otherwise(1).alias("grp"),
    )


def centers64(spark: SparkSession, folder: str) -> list[list[float]]:
    """The first embedding of every label, in label order; a task keeps one vector per label."""
    first = F.min_by("embedding", "vec_id").cast("array<double>").alias("center")
    return collect_centers(table(spark, folder, "embeddings").groupBy("label").agg(first), order="label")


def order_points(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as (thousands of price, tens of customers), group A being finished orders."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.array(F.col("o_totalprice") / 1000, F.col("o_custkey") / 10).alias("point"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("grp"),
    )


def part_centers(spark: SparkSession, folder: str) -> DataFrame:
    """`(k, center)`: a center for every part."""
    center = F.array(F.col("p_retailprice") / 4 - 200, F.col("p_size") * 3.0).alias("center")
    return table(spark, folder, "part").select(F.col("p_partkey").alias("k"), center)


def supplier_centers(spark: SparkSession, folder: str) -> DataFrame:
    """`(segment, k, center)`: the four start centers of every supplier, moved by its key."""
    segments = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("segment")).distinct()
    shift = F.col("segment") % 7 / 4
    cells = [F.struct(F.lit(i).alias("k"), F.array(x + shift, F.lit(y)).alias("center")) for i, (x, y) in enumerate(CENTERS)]
    return segments.select("segment", F.inline(F.array(*cells)))


def point_lines(spark: SparkSession, folder: str, *, tax: bool = False) -> DataFrame:
    """Line items as `quantity,discount[,tax],flag` text."""
    cells = ["l_quantity", "l_discount", *(["l_tax"] if tax else []), "l_returnflag"]
    return table(spark, folder, "lineitem").select(
        F.concat_ws(",", *[F.col(c).cast("string") for c in cells]).alias("value")
    )


def ab_lines(spark: SparkSession, folder: str) -> DataFrame:
    """`quantity,discount,label` text with the labels A, B and R."""
    label = F.translate("l_returnflag", "N", "B")
    return table(spark, folder, "lineitem").select(
        F.concat_ws(",", *[F.col(c).cast("string") for c in ("l_quantity", "l_discount")], label).alias("value")
    )


def doc_lines(spark: SparkSession, folder: str) -> DataFrame:
    return documents_as_lines(table(spark, folder, "documents"))


def live_events(spark: SparkSession, folder: str, *columns: str) -> tuple[DataFrame, int, int]:
    """The events as a stream of slices, with the number of all rows and that of a slice; event ids count from 0."""
    n = table(spark, folder, "events").count()
    step = max(1, -(-n // LIVE_SLICES))
    return table_stream(spark, f"{folder}/events.parquet", columns, step), n, step


def event_items(spark: SparkSession, folder: str) -> DataFrame:
    """`(batch, item)`: user ids with the number of the day they came on."""
    return table(spark, folder, "events").select(
        batch_number("ts", DAY_SECONDS).alias("batch"), F.col("user_id").alias("item")
    )
