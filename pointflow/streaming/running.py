"""The set of items seen so far, kept by a stateful operator, and its size after each batch.

Items are dealt into buckets by a hash. A bucket keeps a map from item to the
batch it came in first, in the state store (on disk), and reports how many items
of a batch it had not seen. `ttl` bounds the state: an item not seen for that long
is forgotten, and is new when it comes again. `within` drops rows that come so
much later than the newest event time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pointflow.operators.batches import running_before
from pointflow.streaming.distinct import BATCH_INTERVAL, _disk_state

NO_DATA_KEY = "spark.sql.streaming.noDataMicroBatches.enabled"
# maps of the state; an item costs a call to the store, so this is how far one batch can spread
BUCKETS = 64


class FirstSeen(StatefulProcessor):
    """Per bucket `(batch, n_new)`: the items whose first row came in that batch."""

    def __init__(self, ttl: timedelta | None):
        self.ttl = int(ttl.total_seconds() * 1000) if ttl else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getMapState("first", "item bigint", "batch bigint", self.ttl)

    def handleInputRows(self, key, rows, timerValues):
        found: dict[int, int] = {}
        for frame in rows:
            # one call to the store per item and delivery, not per row
            for item, batch in frame.groupby("item")["batch"].min().items():
                found[item] = min(batch, found.get(item, batch))
        new: dict[int, int] = {}
        for item, batch in found.items():
            known = self.first.containsKey((int(item),))
            if not known:
                new[batch] = new.get(batch, 0) + 1
            if not known or self.ttl:
                # writing again puts the time of forgetting off
                self.first.updateValue((int(item),), (int(batch),))
        yield pd.DataFrame({"batch": list(new), "n_new": list(new.values())}, dtype="int64")

    def close(self) -> None:
        pass


def _once_a_batch(columns: list[str], event_time: str | None):
    """One row per item and batch of each Arrow batch, with its newest event time: a hot item reaches its bucket a few times."""

    def run(batches):
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(["bucket", "item", "batch"], use_threads=False)
            found = found.aggregate([(event_time, "max")] if event_time else [])
            names = [f"{c}_max" if c == event_time else c for c in columns]
            yield from pa.table([found[n] for n in names], schema=batch.schema).to_batches()

    return run


def _slim(stream: DataFrame, event_time: str | None, within: str | None) -> DataFrame:
    if within is not None and event_time is None:
        raise ValueError("within needs event_time")
    columns = ["bucket", "item", "batch", *([event_time] if event_time else [])]
    slim = stream.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(BUCKETS))).select(*columns)
    slim = slim.mapInArrow(_once_a_batch(columns, event_time), slim.schema)
    return slim.withWatermark(event_time, within) if within else slim


def new_items(
    stream: DataFrame, ttl: timedelta | None = None, event_time: str | None = None, within: str | None = None
) -> DataFrame:
    """A streaming frame `(batch, n_new)` from `(item, batch)`: rows of one batch, from each bucket, add up."""
    return (
        _slim(stream, event_time, within)
        .groupBy("bucket")
        .transformWithStateInPandas(
            FirstSeen(ttl),
            outputStructType="batch bigint, n_new bigint",
            outputMode="Append",
            # without event time Spark drops no late rows
            timeMode="ProcessingTime" if ttl else "EventTime" if within else "None",
        )
    )


@contextmanager
def _data_only(spark: SparkSession, wanted: bool) -> Iterator[None]:
    """No batches without data, of which a query in processing time has no last one; what has expired is not read anyway."""
    chosen = spark.conf.get(NO_DATA_KEY)
    if wanted:
        spark.conf.set(NO_DATA_KEY, "false")
    try:
        yield
    finally:
        spark.conf.set(NO_DATA_KEY, chosen)


def running_distinct(
    stream: DataFrame,
    folder: str,
    ttl: timedelta | None = None,
    event_time: str | None = None,
    within: str | None = None,
    interval: str | None = BATCH_INTERVAL,
) -> DataFrame:
    """`(batch, n_new, n_distinct)` after all that is there now went through; batches without new items have no row.

    With an interval the slices of the source come one after the other.
    """
    spark = stream.sparkSession
    with _disk_state(spark), _data_only(spark, ttl is not None):
        writer = new_items(stream, ttl, event_time, within).writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", f"{folder}/new").option("checkpointLocation", f"{folder}/checkpoint")
        query = writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()
        if interval:
            query.processAllAvailable()
            query.stop()
        query.awaitTermination()
    found = spark.read.schema("batch bigint, n_new bigint").parquet(f"{folder}/new")
    sizes = found.groupBy("batch").agg(F.sum("n_new").alias("n"))
    return running_before(sizes).select("batch", F.col("n").alias("n_new"), (F.col("n_before") + F.col("n")).alias("n_distinct"))
