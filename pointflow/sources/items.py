"""Decimal text lines to 64-bit items, for tables and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointflow.sources.points import _check_on_bad, _settle

# an optional sign and digits only: no blanks, no fraction
ITEM_PATTERN = r"\A[+-]?[0-9]+\z"


def parse_items(lines: DataFrame, on_bad: str = "fail", value: str = "value") -> DataFrame:
    """Adds `item bigint`; a line that is not a plain integer of 64 bits is bad."""
    _check_on_bad(on_bad)
    text = F.col(value)
    item = F.when(text.rlike(ITEM_PATTERN), text.try_cast("bigint"))
    return _settle(lines, item.isNull(), F.coalesce(text, F.lit("NULL")), on_bad, {"item": item}).drop(value)


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table as a stream of its files.

    The path is a glob, because the file source refuses a plain path that is one file and not a folder.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of the text files that arrive in a folder, as a stream of `value`."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
