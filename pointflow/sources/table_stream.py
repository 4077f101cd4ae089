"""A stored table as a live stream, slice by slice.

The reader is a Python data source: the table's files are neither copied nor
rewritten, and no port is opened. Offsets are row numbers over the files in the
order of their paths, so a restarted query goes on at the row where it stopped.
A trigger admits `rows_per_batch` rows; a slice is cut into partitions that read
their rows, and the wanted columns alone, in the executors. The stream is a
snapshot: files that come later are not part of it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "pointflow_table"
# rows of a partition at most
PARTITION_ROWS = 1 << 20


class Piece(InputPartition):
    """Some neighbouring rows of one file."""

    def __init__(self, path: str, first: int, n: int):
        self.path, self.first, self.n = path, first, n


class TableSource(DataSource):
    """Options: `files`, a JSON list of [path, rows]; `arrow_schema` in hexadecimal; `rows_per_batch`, 0 for all."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> TableReader:
        return TableReader(
            json.loads(self.options["files"]), self.options["arrow_schema"], int(self.options.get("rows_per_batch", 0))
        )


class TableReader(DataSourceStreamReader):
    def __init__(self, files: Sequence[tuple[str, int]], arrow_schema: str, step: int):
        self.files, self.arrow_schema, self.step = files, arrow_schema, step
        self.total = sum(n for _, n in files)
        # the row up to which slices were handed out; None until the query says where it stands
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        """The end of the next slice. A restarted query has planned its last slice again before it asks."""
        at = self.at or 0
        self.at = min(self.total, at + self.step) if self.step else self.total
        return {"row": self.at}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        first, last = start["row"], end["row"]
        self.at = max(self.at or 0, last)
        pieces, offset = [], 0
        for path, n in self.files:
            low, high = max(first, offset), min(last, offset + n)
            for at in range(low, high, PARTITION_ROWS):
                pieces.append(Piece(path, at - offset, min(PARTITION_ROWS, high - at)))
            offset += n
        return pieces

    def commit(self, end: dict) -> None:
        self.at = max(self.at or 0, end["row"])

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        schema = pa.ipc.read_schema(pa.py_buffer(bytes.fromhex(self.arrow_schema)))
        store, path = fs.FileSystem.from_uri(partition.path)
        file = pq.ParquetFile(path, filesystem=store)
        skip, left = partition.first, partition.n
        for group in range(file.metadata.num_row_groups):
            rows = file.metadata.row_group(group).num_rows
            if skip >= rows:
                skip -= rows
                continue
            for batch in file.iter_batches(row_groups=[group], columns=schema.names):
                part = batch.slice(min(skip, batch.num_rows), left)
                skip = max(0, skip - batch.num_rows)
                if part.num_rows:
                    left -= part.num_rows
                    yield from pa.Table.from_batches([part]).select(schema.names).cast(schema).to_batches()
                if not left:
                    return


def table_stream(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, rows_per_batch: int | None = None
) -> DataFrame:
    """The Parquet table at `path` as a stream; without `rows_per_batch` all rows come at once.

    The rows of the files are counted by Spark, from the files' footers.
    """
    if rows_per_batch is not None and rows_per_batch < 1:
        raise ValueError("rows_per_batch must be positive")
    table = spark.read.parquet(path)
    files = table.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    listed = sorted((r["path"], r["n"]) for r in files.collect())
    slim = table.select(*columns) if columns else table
    schema = slim.limit(0).toArrow().schema.remove_metadata()
    spark.dataSource.register(TableSource)
    reader = spark.readStream.format(FORMAT).schema(slim.schema).option("files", json.dumps(listed))
    reader = reader.option("arrow_schema", schema.serialize().to_pybytes().hex())
    return reader.option("rows_per_batch", rows_per_batch or 0).load()
