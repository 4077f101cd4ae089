"""Scratch tables in the shared folder, which cut lineage and outlive lost executors."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from pointflow.session import drop_folder, scratch_folder


class Scratch:
    """Named Parquet tables of one call.

    Tables that the returned frame reads must stay; the others are dropped as
    soon as what was made from them is written.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.base = scratch_folder(spark, purpose)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` and read it back."""
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            drop_folder(self.spark, f"{self.base}/{name}")


def need_columns(df: DataFrame, *names: str) -> None:
    """Refuse a frame without the named columns, before any job starts."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores behind it if `df` has such a column, which then stays as it is."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1024


def need_text(df: DataFrame, *names: str) -> None:
    """`need_columns`, and Arrow batches of fewer rows for the session.

    Texts are wide: the usual 10,000 rows of a batch are tens of megabytes in
    the JVM and again in Python, for every running task. A smaller number that
    the session already has stays.
    """
    need_columns(df, *names)
    spark = df.sparkSession
    if int(spark.conf.get(BATCH_ROWS_KEY)) > TEXT_ROWS:
        spark.conf.set(BATCH_ROWS_KEY, TEXT_ROWS)


def text_slices(batches: Iterator[pa.Array], limit: int = 2 << 20) -> Iterator[list[str | None]]:
    """The texts of Arrow batches in lists of about `limit` bytes each; a longer text is a list of its own.

    A batch has a fixed number of rows, whatever their lengths. What a task
    makes of a list goes back before the next one is read, so its memory depends
    on the limit and the longest text alone.
    """
    for batch in batches:
        yield from batch_slices(batch, limit)
    give_back()


def batch_slices(batch: pa.Array, limit: int = 2 << 20) -> Iterator[list[str | None]]:
    """The lists of one batch. Who takes batches one by one calls `give_back` after the last."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start).to_pylist()
        start = stop


def give_back() -> None:
    """Free what a task has let go, as an idle worker should not sit on what its last task needed.

    Once a task: freed pages are faulted in again, which costs more than many operators do with a batch.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
