"""Exact dedup with a split of heavy hitters.

Digests of whole normalised texts are written once. Misra-Gries summaries of
the tasks name every digest that may be frequent; one counting pass verifies
them, and their winners, a bounded number, are broadcast. Rows of frequent
digests are then decided where they are read, and only the others are shuffled
by digest, where no digest has many rows any more.

Defined results: a NULL text counts as empty. Only A-Z are lowered. Of equal
texts the row with the largest id stays, a NULL id being below all others; of
rows that repeat text and id exactly one stays. An empty table gives an empty
result. Other columns are carried along whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointflow.llm.tables import Scratch, need_columns

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# counters per task; a digest with more than 1 / (counters + 1) of a task's rows is never missed there
COUNTERS = 512


def normal_text(text: str | Column) -> Column:
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)


def text_digest(text: str | Column) -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(normal_text(text).cast("binary"), 256))


def merge_counts(state: dict[bytes, int], values: list[bytes], counts: list[int], counters: int) -> None:
    """Add counted values to a Misra-Gries summary and cut it back to `counters` entries.

    Cutting takes the (counters + 1)-th largest count off every entry, so a
    count is too low by at most rows / (counters + 1) in all.
    """
    for value, count in zip(values, counts):
        state[value] = state.get(value, 0) + count
    if len(state) > counters:
        ranked = np.sort(np.fromiter(state.values(), dtype=np.int64))[::-1]
        cut = int(ranked[counters])
        for value in [v for v, c in state.items() if c <= cut]:
            del state[value]
        for value in state:
            state[value] -= cut


def _summaries(counters: int):
    def run(batches):
        state: dict[bytes, int] = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            tally = batch.column(0).value_counts()
            merge_counts(state, tally.field("values").to_pylist(), tally.field("counts").to_pylist(), counters)
        # the bound on the error of this task's counts travels with them
        error = rows // (counters + 1)
        yield pa.RecordBatch.from_pydict(
            {
                "digest": pa.array([None, *state], pa.binary()),
                "low": pa.array([error, *state.values()], pa.int64()),
                "rows": pa.array([rows, *[0] * len(state)], pa.int64()),
            }
        )

    return run


def heavy_candidates(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """`digest` of every value with more than 2 / (counters + 1) of all rows, and at most `counters + 1` values.

    Summed counts are too low by at most rows / (counters + 1), so the values
    above that line include all that are truly above twice of it.
    """
    tallies = digests.select("digest").mapInArrow(_summaries(counters), "digest binary, low long, rows long")
    sums = tallies.groupBy("digest").agg(F.sum("low").alias("low"), F.sum("rows").alias("rows"))
    total = sums.where("digest IS NULL").agg(F.max("rows").alias("rows")).first()["rows"] or 0
    line = max(1, total // (counters + 1))
    return sums.where(F.col("digest").isNotNull() & (F.col("low") > line)).select("digest")


def _winners(digests: DataFrame, candidates: DataFrame) -> DataFrame:
    """`digest, heavy_keep, heavy_size`: the exact count and largest id of each candidate, at most COUNTERS + 1 rows."""
    return (
        digests.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("id").alias("heavy_keep"), F.count("*").alias("heavy_size"))
    )


def exact_groups(docs: DataFrame, ident: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """`ident, keep_id, group_size, kept, digest`, one row per row of `docs`."""
    need_columns(docs, ident, text)
    scratch = Scratch(docs.sparkSession, "heavy-dedup")
    digests = scratch.keep(docs.select(F.col(ident).alias("id"), text_digest(text).alias("digest")), "digests")
    candidates = scratch.keep(heavy_candidates(digests, counters), "candidates")
    winners = scratch.keep(_winners(digests, candidates), "winners")
    marked = digests.join(F.broadcast(winners), "digest", "left")
    lost = F.col("heavy_size").isNotNull() & ~F.col("id").eqNullSafe(F.col("heavy_keep"))
    decided = marked.where(lost).select(
        "id", F.col("heavy_keep").alias("keep_id"), F.col("heavy_size").alias("group_size"), F.lit(False).alias("kept"), "digest"
    )
    same = Window.partitionBy("digest")
    first = F.row_number().over(same.orderBy(F.col("id").desc_nulls_last())) == 1
    shuffled = marked.where(~lost).select(
        "id",
        F.max("id").over(same).alias("keep_id"),
        F.coalesce("heavy_size", F.count("*").over(same)).alias("group_size"),
        first.alias("kept"),
        "digest",
    )
    return decided.union(shuffled).withColumnRenamed("id", ident)


def exact_dedup(docs: DataFrame, ident: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Losers of heavy digests go before the shuffle; what is shuffled whole are
    one row or few per digest.
    """
    need_columns(docs, ident, text)
    scratch = Scratch(docs.sparkSession, "heavy-dedup")
    digests = scratch.keep(docs.select(F.col(ident).alias("id"), text_digest(text).alias("digest")), "digests")
    candidates = scratch.keep(heavy_candidates(digests, counters), "candidates")
    winners = scratch.keep(_winners(digests, candidates), "winners")
    scratch.drop("digests", "candidates")
    whole = docs.select(F.struct("*").alias("doc"), F.col(ident).alias("id"), text_digest(text).alias("digest"))
    marked = whole.join(F.broadcast(winners), "digest", "left")
    left = marked.where(F.col("heavy_size").isNull() | F.col("id").eqNullSafe(F.col("heavy_keep")))
    rank = F.row_number().over(Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last()))
    return left.withColumn("rank", rank).where("rank = 1").select("doc.*")
