"""Distinct items of a stream, drained or up to a threshold.

The functions take any streaming frame with an `item` column. What they learn
is kept in the state store or in tables below a shared folder, never in the
driver, so a restarted query goes on where the last one was committed.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from pointflow.operators.batches import summary_of_counts
from pointflow.session import drop_folder, folder_exists

STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH_INTERVAL = "100 milliseconds"
# closed batches that share a folder in the end
MERGE_EVERY = 500
SIZES = "n bigint, seen bigint, at timestamp"
# called with a place in the loop and a batch number, see `faults`
Hook = Callable[[str, int], None]


@contextmanager
def _disk_state(spark: SparkSession) -> Iterator[None]:
    """Keep state on disk unless the session names a store; a set of all items outgrows memory."""
    chosen = spark.conf.get(STATE_STORE_KEY, None)
    if chosen and "HDFSBacked" not in chosen:
        yield
        return
    spark.conf.set(STATE_STORE_KEY, ROCKSDB)
    try:
        yield
    finally:
        if chosen:
            spark.conf.set(STATE_STORE_KEY, chosen)
        else:
            spark.conf.unset(STATE_STORE_KEY)


def ends_of_each(stream: DataFrame, item: str = "item", event_time: str | None = None) -> DataFrame:
    """Drop the repeats inside each Arrow batch: one row per item, or its first and its last by event time.

    `dropDuplicates` on a stream has no map-side part; with this before it, a
    hot item reaches its state task a few times per input split, not once per
    row. The last row moves the watermark as all rows would, and is on time if
    any is, so no item is lost with a late first row.
    """

    def once(batches):
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by([item], use_threads=False)
            if event_time is None:
                yield from found.aggregate([]).select([item]).cast(batch.schema).to_batches()
                continue
            found = found.aggregate([(event_time, "min"), (event_time, "max")])
            for end in ("min", "max"):
                columns = [found[item if c == item else f"{event_time}_{end}"] for c in batch.schema.names]
                yield from pa.table(columns, schema=batch.schema).to_batches()

    slim = stream.select(item) if event_time is None else stream.select(item, event_time)
    return slim.mapInArrow(once, slim.schema)


def stream_distinct(
    stream: DataFrame, item: str = "item", within: str | None = None, event_time: str | None = None
) -> DataFrame:
    """A streaming frame that emits every item once.

    The state grows with the number of items. `within` bounds it: a repeat that
    comes later than that after the item's first `event_time` may be emitted again.
    """
    if within is None:
        return ends_of_each(stream, item).dropDuplicates([item])
    if event_time is None:
        raise ValueError("within needs event_time")
    slim = ends_of_each(stream, item, event_time)
    return slim.withWatermark(event_time, within).dropDuplicatesWithinWatermark([item])


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def drain_distinct(stream: DataFrame, folder: str, item: str = "item") -> DataFrame:
    """Run `stream_distinct` over what is there now and return the items it wrote below `folder`."""
    spark = stream.sparkSession
    with _disk_state(spark):
        query = (
            stream_distinct(stream, item)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{folder}/items")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(stream.select(item).schema).parquet(f"{folder}/items")


class BatchTables:
    """What the batches of one query left behind, one folder per batch number.

    `items` has the distinct items of a batch with their counts; `sizes` has one
    row per batch with its size, the running total and the time of writing. A
    batch that is processed again overwrites its own folders, so at-least-once
    delivery changes nothing.

    Every MERGE_EVERY batches the closed ones before are merged into one folder
    of a block, and their own folders dropped. A block counts once its sizes are
    there, and from then on whatever is left of its batches does not.

    A batch is two jobs: its items, whose number is observed as they are written,
    and its mark. The running total of the batch before is remembered, and read
    from its mark where it is not known, as after a restart.
    """

    def __init__(self, spark: SparkSession, folder: str, item: str = "item", hook: Hook | None = None):
        self.spark, self.folder, self.item = spark, folder.rstrip("/"), item
        self._items = f"`{item}` bigint, cnt bigint"
        self._hook = hook or (lambda place, number: None)
        self._last: tuple[int, int] | None = None

    def _part(self, table: str, number: int) -> str:
        return f"{self.folder}/{table}/batch_id={number}"

    def _block(self, table: str, block: int) -> str:
        return f"{self.folder}/{table}_blocks/block={block}"

    def _read(self, table: str, schema: str) -> DataFrame:
        """All rows of a table: those of merged blocks, and of the batches that are in none of them."""
        whole = f"{schema}, batch_id bigint"
        empty = self.spark.createDataFrame([], whole)
        batches = self.spark.read.schema(whole).parquet(f"{self.folder}/{table}") if self._there(table) else empty
        if not self._there("sizes_blocks"):
            return batches
        done = self.spark.read.schema("seen bigint, block bigint").parquet(f"{self.folder}/sizes_blocks")
        done = done.select("block").distinct()
        left = batches.withColumn("block", F.floor(F.col("batch_id") / MERGE_EVERY)).join(done, "block", "left_anti")
        merged = self.spark.read.schema(f"{whole}, block bigint").parquet(f"{self.folder}/{table}_blocks")
        return left.drop("block").unionByName(merged.join(done, "block", "left_semi").drop("block"))

    def _there(self, table: str) -> bool:
        return folder_exists(self.spark, f"{self.folder}/{table}")

    def _merge(self, block: int) -> None:
        """Put the batches of a block into one folder; the sizes come last and make it count."""
        numbers = range(block * MERGE_EVERY, (block + 1) * MERGE_EVERY)
        if folder_exists(self.spark, f"{self._block('sizes', block)}/_SUCCESS"):
            return
        inside = F.floor(F.col("batch_id") / MERGE_EVERY) == block
        items = self._read("items", self._items).where(inside)
        items = items.groupBy(self.item).agg(F.sum("cnt").alias("cnt")).withColumn("batch_id", F.lit(numbers[0]).cast("bigint"))
        items.write.mode("overwrite").parquet(self._block("items", block))
        sizes = self._read("sizes", SIZES).where(inside)
        sizes.coalesce(1).write.mode("overwrite").parquet(self._block("sizes", block))
        for number in numbers:
            for table in ("items", "sizes"):
                drop_folder(self.spark, self._part(table, number))

    def seen_before(self, number: int) -> int:
        """Items counted up to the batch before, from that batch's committed row alone."""
        if number == 0:
            return 0
        if self._last and self._last[0] == number - 1:
            return self._last[1]
        path = self._part("sizes", number - 1)
        if not folder_exists(self.spark, path):
            path = self._block("sizes", (number - 1) // MERGE_EVERY)
            marks = self.spark.read.schema(f"{SIZES}, batch_id bigint").parquet(path)
            return marks.where(F.col("batch_id") == number - 1).first()["seen"]
        return self.spark.read.schema(SIZES).parquet(path).first()["seen"]

    def write(self, batch: DataFrame, number: int, threshold: int | None = None) -> int:
        """Store one batch, or an empty mark if the threshold was reached before it; returns the running total."""
        before = self.seen_before(number)
        taken = threshold is None or before < threshold
        n = 0
        if taken:
            seen = Observation()
            counts = batch.groupBy(self.item).agg(F.count(F.lit(1)).alias("cnt"))
            # above the aggregate, where adaptive execution leaves it also if there are no items
            counts = counts.observe(seen, F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"))
            counts.write.mode("overwrite").parquet(self._part("items", number))
            n = seen.get["n"]
        else:
            # what an earlier attempt with a higher threshold wrote
            drop_folder(self.spark, self._part("items", number))
        self._hook("items", number)
        mark = self.spark.range(1).select(
            F.lit(n).cast("bigint").alias("n"),
            F.lit(before + n).cast("bigint").alias("seen"),
            F.current_timestamp().alias("at"),
        )
        # the mark comes last: a batch counts as done once its row is there
        mark.coalesce(1).write.mode("overwrite").parquet(self._part("sizes", number))
        self._last = (number, before + n)
        self._hook("mark", number)
        if number % MERGE_EVERY == 0 and number:
            self._merge(number // MERGE_EVERY - 1)
        return before + n

    def sizes(self) -> DataFrame:
        """`(batch_id, n)` of the batches that had items."""
        return self.log().select("batch_id", "n")

    def log(self) -> DataFrame:
        """`(batch_id, at, n, seen)`: also the time at which a batch was written, and the items up to it."""
        return self._read("sizes", SIZES).where("n > 0").select("batch_id", "at", "n", "seen")

    def empty_batches(self) -> DataFrame:
        """`batch_id, seen` of the batches that had no items, which have no row in `sizes`."""
        return self._read("sizes", SIZES).where("n = 0").select("batch_id", "seen")

    def counts(self) -> DataFrame:
        """`(item, cnt)` over all batches."""
        table = self._read("items", self._items)
        return table.groupBy(self.item).agg(F.sum("cnt").alias("cnt"))

    def summary(self) -> DataFrame:
        """One row `processed, n_distinct, largest`."""
        return summary_of_counts(self.counts(), self.item)


def start_batches(
    stream: DataFrame,
    folder: str,
    threshold: int | None = None,
    item: str = "item",
    interval: str | None = BATCH_INTERVAL,
    hook: Hook | None = None,
) -> tuple[StreamingQuery, BatchTables, threading.Event]:
    """Start the micro-batch loop; the event is set once the threshold is reached.

    `interval=None` processes what is there now and ends by itself. `hook` is
    called after the items and after the mark of each batch.
    """
    if threshold is not None and threshold < 1:
        raise ValueError("threshold must be positive")
    tables = BatchTables(stream.sparkSession, folder, item, hook)
    reached = threading.Event()

    def process(batch: DataFrame, number: int) -> None:
        # streams switch this off for the sake of state; here it keeps a small batch to one output file
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        seen = tables.write(batch, number, threshold)
        if threshold is not None and seen >= threshold:
            reached.set()

    query = (
        stream.select(item)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{tables.folder}/checkpoint")
        .trigger(**_trigger(interval))
        .start()
    )
    return query, tables, reached


def run_batches(
    stream: DataFrame,
    folder: str,
    threshold: int | None = None,
    item: str = "item",
    interval: str | None = None,
    poll_seconds: float = 0.2,
    hook: Hook | None = None,
) -> BatchTables:
    """Process until the threshold is reached or the input ends, then stop without draining the rest.

    With an interval and no threshold the query stops once it has found nothing new.
    """
    query, tables, reached = start_batches(stream, folder, threshold, item, interval, hook)
    if interval and threshold is None:
        query.processAllAvailable()
        query.stop()
    while query.isActive and not reached.wait(poll_seconds):
        pass
    if reached.is_set():
        query.stop()
    if query.exception():
        raise query.exception()
    return tables
