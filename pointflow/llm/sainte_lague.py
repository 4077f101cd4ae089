"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources share the mix by weight, none above `repeats` times its own size; what
a capped source leaves is shared again among the others. Blocks of BLOCK_WORDS
words are given to sources by the highest quotients target / (2 n + 1), and a
source's blocks in the same way to its shards, by shard size; where a source has
very many, first to groups of them, so that no task deals to all. A shard lays its
documents end to end in a seeded order, closes that line to a ring, and takes
its quota of blocks from a seeded start; a quota above the ring's length goes
round again, so a word is taken at most `repeats` times. The last block of a
source or shard may be a short one, which ends there; what short blocks lack is
dealt on as further blocks.

Highest quotients are what rounding target / d gives for the right divisor d,
so d is found by bisection and only ties are dealt one by one.

Rows are written once with a number. All dealing and laying works on numbers and
sizes; the texts of the documents taken are joined to them at the end.

Defined results: a NULL text has no words. A document without words is never
taken. Sources are ordered by code point, a NULL source last, and take their
weights from that order. With no words at all every target is 0. Repeated rows
are documents of their own, a NULL id is spread by its text. An empty table
gives an empty result. Other columns are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointflow.llm.tables import Scratch, need_columns

WORD = r"[^\x20\x09-\x0D]+"
WORD_GAP = r"[\x20\x09-\x0D]+"
BLOCK_WORDS = 16
# documents of a shard, which bounds the rows that one task sorts
SHARD_DOCS = 2048
# shards of a group, whose quotas one task deals
GROUP_SHARDS = 4096
# sources are listed on the driver, like their weights; more are refused
MAX_SOURCES = 1_000_000


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def share_targets(sizes: Sequence[int], weights: Sequence[float], total: float, repeats: float) -> np.ndarray:
    """Targets by weight, capped at `repeats` times the size, the excess shared again until none is above."""
    sizes, weights = np.asarray(sizes, dtype=float), np.asarray(weights, dtype=float)
    caps = repeats * sizes
    target, free = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool)
    while free.any():
        rest = total - caps[~free].sum()
        target = np.where(free, rest * weights / weights[free].sum(), caps)
        above = free & (target > caps)
        if not above.any():
            break
        free &= ~above
    return np.minimum(target, caps)


def sainte_lague(votes: Sequence[float], caps: Sequence[int], seats: int) -> np.ndarray:
    """Seats by the highest quotients votes / (2 n + 1), none above its cap; equal quotients go to the first."""
    votes, caps = np.asarray(votes, dtype=float), np.asarray(caps, dtype=np.int64)
    caps = np.where(votes > 0, caps, 0)
    seats = min(int(seats), int(caps.sum()))
    if seats <= 0:
        return np.zeros(len(votes), dtype=np.int64)

    def given(divisor: float) -> np.ndarray:
        # the seats whose quotient is above divisor / 2
        return np.minimum(np.ceil(votes / divisor - 0.5).clip(0), caps).astype(np.int64)

    low, high = votes[votes > 0].min() / (2.0 * (seats + 1)), 2 * votes.max() + 1
    for _ in range(200):
        middle = (low + high) / 2
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = given(high)
    while (missing := seats - int(out.sum())) > 0:
        quotient = np.where(out < caps, votes / (2 * out + 1), -1.0)
        best = np.argsort(-quotient, kind="stable")[: min(missing, int((out < caps).sum()))]
        # one seat each, and only to those that no second seat of another would precede
        second = (votes[best] / (2 * out[best] + 3)).max()
        take = best[quotient[best] >= second]
        out[take if len(take) else best[:1]] += 1
    return out


def dealt_words(votes: Sequence[float], limits: Sequence[int], block: int, total: float, slack: float) -> np.ndarray:
    """Words by blocks of the highest quotients, none above its limit, where its last block ends short.

    If short blocks leave more than `slack` of the total, the fewest blocks are dealt that leave no more.
    """
    limits = np.asarray(limits, dtype=np.int64)
    caps = -(-limits // block)

    def dealt(seats: int) -> np.ndarray:
        return np.minimum(sainte_lague(votes, caps, seats) * block, limits)

    low, high = max(round(total / block), int(total > 0)), int(caps.sum())
    out = dealt(low)
    if total - out.sum() <= slack or low >= high:
        return out
    while low + 1 < high:
        middle = (low + high) // 2
        if total - dealt(middle).sum() <= slack:
            high = middle
        else:
            low = middle
    return dealt(high)


def _quotas(key: str, block: int, repeats: int):
    """Deals the `quota` of the rows' group to its rows by their words."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(key)
        words = rows.column("words").to_numpy()
        take = dealt_words(words, repeats * words, block, rows.column("quota")[0].as_py(), 0)
        return rows.drop_columns("quota").append_column("take", pa.array(take, pa.int64()))

    return run


def _dealt(sums: DataFrame, sources: DataFrame, block: int, repeats: int) -> DataFrame:
    """`place, shard, words, take` from `place, team, shard, words`: quotas of sources go to teams of shards, then to shards."""
    teams = sums.groupBy("place", "team").agg(F.sum("words").alias("words"))
    teams = teams.join(F.broadcast(sources.select("place", "quota")), "place").groupBy("place")
    teams = teams.applyInArrow(_quotas("team", block, repeats), "place int, team long, words long, take long")
    shards = sums.join(teams.select("place", "team", F.col("take").alias("quota")), ["place", "team"])
    shards = shards.groupBy("place", "team").applyInArrow(
        _quotas("shard", block, repeats), "place int, team long, shard long, words long, take long"
    )
    return shards.select("place", "shard", "words", "take")


def mix_pieces(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 42,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_docs: int = SHARD_DOCS,
    group_shards: int = GROUP_SHARDS,
) -> DataFrame:
    """Per row of `docs`: `id, source, size, source_size, target, pieces`.

    `pieces` lists the runs of words that the mix takes, as (first word from 0,
    words); a document that goes into the mix twice has two of them. The mix has
    `share` times the words of all documents.
    """
    need_columns(docs, ident, text, source)
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.keep(_sized(docs, ident, text, source), "sizes")
    pieces = _pieces(scratch, rows, weights, share, repeats, seed, block_words, shard_docs, group_shards)
    return pieces.select("id", "source", "size", "source_size", "target", "pieces")


def _sized(docs: DataFrame, ident: str, text: str, source: str, *more: Column) -> DataFrame:
    """What the mix needs of a row, under a number that holds once it is written."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(ident).alias("id"),
        F.xxhash64(F.lit(0), text).alias("mark"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        *more,
    )


def _pieces(
    scratch: Scratch,
    rows: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 42,
    block_words: int = BLOCK_WORDS,
    shard_docs: int = SHARD_DOCS,
    group_shards: int = GROUP_SHARDS,
) -> DataFrame:
    """`row, id, source, size, source_size, target, pieces` for `rows(row, id, mark, source, size)`."""
    per_source = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    listed = per_source.limit(MAX_SOURCES + 1).collect()
    if len(listed) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    # order by UTF-8 bytes is order by code point
    listed.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
    words = [r["words"] for r in listed]
    weight = [weights[i % len(weights)] for i in range(len(listed))]
    target = share_targets(words, weight, share * sum(words), repeats)
    quota = dealt_words(target, [repeats * w for w in words], block_words, float(target.sum()), block_words / 2)
    plan = [
        (r["source"], i, int(r["words"]), float(target[i]), int(quota[i]), max(1, -(-r["docs"] // shard_docs)))
        for i, r in enumerate(listed)
    ]
    sources = scratch.spark.createDataFrame(
        plan, "source string, place int, source_size long, target double, quota long, shards long"
    )

    # the list of sources is bounded by MAX_SOURCES
    def placed(frame: DataFrame) -> DataFrame:
        joined = frame.withColumnRenamed("source", "own").join(F.broadcast(sources), F.col("own").eqNullSafe(F.col("source")))
        draw = F.xxhash64(F.lit(seed), "id", "mark")
        shard = F.pmod(draw, "shards")
        return joined.withColumn("shard", shard).withColumn("team", F.pmod("shard", F.ceil(F.col("shards") / group_shards)))

    sums = placed(rows).groupBy("place", "team", "shard").agg(F.sum("size").alias("words"))
    sums = scratch.keep(sums, "sums")
    quotas = scratch.keep(_dealt(sums, sources, block_words, repeats), "quotas")
    in_shard = Window.partitionBy("place", "shard")
    # rows that are equal in all of these are alike, so it does not matter which comes first
    order = in_shard.orderBy(F.xxhash64(F.lit(seed + 1), "id", "mark"), "id", "mark", "size")
    order = order.rowsBetween(Window.unboundedPreceding, -1)
    laid = placed(rows).withColumn("offset", F.coalesce(F.sum("size").over(order), F.lit(0)))
    ringed = laid.join(quotas, ["place", "shard"], "left").withColumn(
        "start", F.when(F.col("words") > 0, F.pmod(F.xxhash64(F.lit(seed + 2), "place", "shard"), "words")).otherwise(0)
    )

    def piece(turn: Column) -> Column:
        at = F.col("offset") + turn * F.col("words")
        first = F.greatest(at, "start")
        last = F.least(at + F.col("size"), F.col("start") + F.col("take"))
        return F.struct((first - at).alias("first"), (last - first).alias("n"))

    turns = F.array(*[piece(F.lit(t)) for t in range(repeats + 1)])
    pieces = F.filter(turns, lambda p: p["n"] > 0).alias("pieces")
    return ringed.select("row", "id", F.col("own").alias("source"), "size", "source_size", "target", pieces)


def taken_words(pieces: str | Column = "pieces") -> Column:
    return F.aggregate(pieces, F.lit(0).cast("bigint"), lambda total, p: total + p["n"])


def mix_documents(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The mix itself, in the columns of `docs`: one row per piece.

    A whole document keeps its text as it is. At the two ends of a shard's run a
    document is cut; its words are then joined by single blanks.
    """
    need_columns(docs, ident, text, source)
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.keep(_sized(docs, ident, text, source, F.struct("*").alias("doc")), "rows")
    pieces = _pieces(scratch, rows.drop("doc"), **options)
    each = pieces.select("row", "size", F.explode("pieces").alias("piece")).join(rows.select("row", "doc"), "row")
    cut = F.col("piece.n") < F.col("size")
    body = F.col("doc").getField(text)
    # the text may begin with white space, which gives an empty first cell
    cells = F.filter(F.split(body, WORD_GAP), lambda w: w != "")
    part = F.array_join(F.slice(cells, (F.col("piece.first") + 1).cast("int"), F.col("piece.n").cast("int")), " ")
    columns = [F.col("doc").getField(c).alias(c) for c in docs.columns if c not in (text, "n_chars")]
    shown = {text: F.when(cut, part).otherwise(body)}
    if "n_chars" in docs.columns:
        shown["n_chars"] = F.when(cut, F.length(part)).otherwise(F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    return each.select(*columns, *[c.alias(n) for n, c in shown.items()]).select(*docs.columns)
