"""MinHash near-dedup with sequential Bayesian verification.

1. Each text becomes its set of word shingles and a signature of 128 16-bit
   marks. Texts with equal sets form a class, which goes on as one node, so
   copies never meet again.
2. Four marks make a band key; nodes that share one are a bucket. Two sets of
   similarity 0.8 miss all 32 bands with a probability of 5e-8.
3. Every member of a bucket is compared with the bucket's smallest member
   only. Signatures are compared a batch of marks at a time: a pair is pruned
   once the posterior probability (uniform prior) that its similarity reaches
   the threshold is below MISS. Survivors are verified exactly on the full sets
   of their whole texts. Verified links give components.
4. Buckets whose members are still in several components are cut into blocks
   of bounded members and shingles, and every pair of blocks, a tile, compares
   signatures across components. Members with a survivor go on with their texts
   to the same tile, which verifies on full sets and returns a spanning forest
   of the links. So no pair that could join two components is left out, and no
   bucket's pairs are ever written out.

Similarities are compared in integers: 100 |A & B| >= percent |A | B|.

Defined results: a text without words, empty or NULL, has no shingles and is
linked with nothing. Nodes are numbered, and known by the 128-bit key of their
set, so rows that repeat an id are judged by their texts. Rows with a NULL id are compared among
themselves only, and their component is NULL. `kept` says that a row's id is its
component's (NULL as NULL). Of each component `near_dedup` keeps the smallest id, of its texts in
the component the one of the smallest hash; of rows that repeat id and text, and
have words, it keeps one. An empty table gives
an empty result. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointflow.llm.components import connected, forest
from pointflow.llm.shingles import BANDS, HASHES, set_key, shingle_sets, signatures
from pointflow.llm.tables import Scratch, give_back, need_text, text_slices

# probability with which a pair at the threshold may be pruned
MISS = 1e-7
# marks that are compared at a time
BATCH = 16
# members of one block of a large bucket, and the shingles that they may have
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 400_000
# pairs whose signatures are compared at a time
PAIR_SLICE = 1 << 16
# shingles that so many members share are counted by a matrix product, so many columns at a time
DENSE_FROM = 16
# what names a tile: a bucket and two of its blocks
TILE = ("bucket", "low", "high")
DENSE_COLUMNS = 2048


@functools.cache
def least_matches(percent: int) -> np.ndarray:
    """Matches that a pair needs after each batch of marks to stay.

    With a uniform prior, P(similarity >= t | m of n agree) is the probability
    of at most m successes among n + 1 draws with chance t.
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= MISS:
                break
            m += 1
        out.append(m)
    return np.array(out)


def surviving(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of signature rows may reach the threshold; most are decided by their first marks."""
    active, matches = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
    for step, least in enumerate(least_matches(percent)):
        part = slice(step * BATCH, (step + 1) * BATCH)
        matches = matches + (left[active, part] == right[active, part]).sum(axis=1)
        stay = matches >= least
        active, matches = active[stay], matches[stay]
    out = np.zeros(len(left), dtype=bool)
    out[active] = True
    return out


def _marks(column: pa.Array) -> np.ndarray:
    """A column of BANDS 64-bit band keys as rows of HASHES marks."""
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, HASHES)


def shingle_columns(text: str | Column, width: int) -> Column:
    """`n` distinct shingles, `key` of the set (NULL if empty) and `bands`, the signature as 64-bit band keys."""

    @F.arrow_udf("struct<n: bigint, key: binary, bands: array<bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            values, offsets = shingle_sets(texts, width)
            keys = [set_key(values[a:b]) if b > a else None for a, b in zip(offsets, offsets[1:])]
            bands = signatures(values, offsets).view(np.int64)
            starts = pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32))
            lists = pa.ListArray.from_arrays(starts, pa.array(bands.reshape(-1)))
            counts = pa.array(np.diff(offsets))
            yield pa.StructArray.from_arrays([counts, pa.array(keys, pa.binary()), lists], names=["n", "key", "bands"])

    return run(text)


def _alike(percent: int):
    @F.arrow_udf("boolean")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(surviving(_marks(left), _marks(right), percent))

    return run


def _linked(width: int, percent: int):
    """Exact comparison of the full sets of two texts."""

    @F.arrow_udf("boolean")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        out = np.zeros(len(left), dtype=bool)
        for k in range(len(left)):
            values, (a, b, c) = shingle_sets([left[k].as_py(), right[k].as_py()], width)
            common = len(np.intersect1d(values[a:b], values[b:c], assume_unique=True))
            out[k] = common > 0 and 100 * common >= percent * ((c - a) - common)
        return pa.array(out)

    return run


def _verified(texts: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The links among `pairs(a, b)`."""
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b"
    )
    return joined.where(_linked(width, percent)("left", "right")).select("a", "b")


def _pairs_apart(labels: np.ndarray, sides: np.ndarray, one: bool):
    """Index pairs of a tile whose components differ, in slices: within the block, or from one block to the other."""
    first = np.arange(len(labels)) if one else np.flatnonzero(sides == 0)
    second = first if one else np.flatnonzero(sides == 1)
    step = max(1, PAIR_SLICE // max(1, len(second)))
    for at in range(0, len(first), step):
        part = first[at : at + step]
        i, j = np.repeat(part, len(second)), np.tile(second, len(part))
        stay = labels[i] != labels[j]
        if one:
            stay &= i < j
        yield i[stay], j[stay]


def common_counts(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, in the upper triangle."""
    n = len(offsets) - 1
    order = np.argsort(values, kind="stable")
    member = np.repeat(np.arange(n), np.diff(offsets))[order]
    group = np.cumsum(np.concatenate([[0], np.diff(values[order]) != 0])) if len(values) else np.zeros(0, np.int64)
    size = np.bincount(group, minlength=1)
    total = np.zeros((n, n), dtype=np.float32)
    dense = np.flatnonzero(size >= DENSE_FROM)
    column = np.full(len(size), -1)
    column[dense] = np.arange(len(dense))
    of = column[group]
    for at in range(0, len(dense), DENSE_COLUMNS):
        here = (of >= at) & (of < at + DENSE_COLUMNS)
        marks = np.zeros((n, DENSE_COLUMNS), dtype=np.float32)
        marks[member[here], of[here] - at] = 1
        total += marks @ marks.T
    few = of < 0
    member, group = member[few], group[few]
    for step in range(1, DENSE_FROM - 1):
        same = np.flatnonzero(group[step:] == group[:-step])
        if not len(same):
            break
        np.add.at(total, (member[same], member[same + step]), 1)
    return total


def _by_tile(schema: list[str], judge):
    """Runs `judge` on the rows of each tile; rows come sorted by tile, in batches that do not end with a tile."""

    def edges(table):
        return np.flatnonzero(np.any([np.diff(table.column(c).to_numpy()) != 0 for c in TILE], axis=0))

    def emit(table):
        bounds = [0, *(edges(table) + 1).tolist(), table.num_rows] if table.num_rows else []
        for a, b in zip(bounds, bounds[1:]):
            arrays = judge(table.slice(a, b - a).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=schema)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            edge = edges(held)
            if len(edge):
                last = int(edge[-1]) + 1
                yield from emit(held.slice(0, last))
                held = held.slice(last)
        if held is not None:
            yield from emit(held)
        held = None
        give_back()

    return run


def _tile_columns(table: pa.Table):
    one = bool(table.column("one")[0].as_py())
    return table.column("node").to_numpy(), table.column("label").to_numpy(), table.column("side").to_numpy(), one


def _survivors(percent: int):
    """Members of a tile with a pair across components that survives and that no earlier band has seen."""

    def judge(table):
        ids, labels, sides, one = _tile_columns(table)
        marks = _marks(table.column("bands").chunk(0))
        keys, used = marks.view(np.int64), np.zeros(len(ids), dtype=bool)
        # the first band in which all agree; an earlier one of a pair is a bucket that sees the pair too
        agreed = (keys == keys[0]).all(axis=0)
        band = agreed.argmax()
        for i, j in _pairs_apart(labels, sides, one):
            stay = surviving(marks[i], marks[j], percent)
            i, j = i[stay], j[stay]
            # without one the bucket is two of equal hash, and sees all its pairs
            fresh = (keys[i] == keys[j]).argmax(axis=1) == band if agreed.any() else np.ones(len(i), dtype=bool)
            used[i[fresh]] = used[j[fresh]] = True
        return [table.column(c).to_numpy(zero_copy_only=False)[used] for c in names]

    names = [*TILE, "node", "label", "side", "one"]
    return _by_tile(names, judge)


def _tile_links(width: int, percent: int):
    """A spanning forest of a tile's links across components, verified on full sets."""

    def judge(table):
        ids, labels, sides, one = _tile_columns(table)
        values, offsets = shingle_sets(table.column("text").to_pylist(), width)
        common, n = common_counts(values, offsets), np.diff(offsets)
        common = np.maximum(common, common.T)
        left, right = [], []
        for i, j in _pairs_apart(labels, sides, one):
            c = common[i, j]
            linked = (c > 0) & (100 * c >= percent * (n[i] + n[j] - c))
            left.append(i[linked])
            right.append(j[linked])
        i, j = (np.concatenate([*x, np.zeros(0, dtype=np.int64)]).astype(np.int64) for x in (left, right))
        root = forest(len(ids), i, j)
        moved = np.flatnonzero(root != np.arange(len(ids)))
        return [ids[moved], ids[root[moved]]]

    return _by_tile(["a", "b"], judge)


def _across(
    scratch: Scratch, texts: DataFrame, nodes: DataFrame, crowded: DataFrame, comps: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links `a, b` between different components, from the buckets that hold more than one."""
    members = crowded.join(comps, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("label"))
    # what is known of a bucket is written before it joins its members, so that the join can split a hot bucket
    labels = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = scratch.keep(labels.where("low <> high").select("bucket"), "labels")
    signed = scratch.keep(members.join(mixed, "bucket", "left_semi").join(nodes.select("node", "n", "bands"), "node"), "mixed")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    spread = signed.join(scratch.keep(signed.groupBy("bucket").agg(blocks), "blocks"), "bucket")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    tiles = spread.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), "blocks")).select("*", other)
    tiles = tiles.select(
        "bucket",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "node",
        "label",
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        (F.col("block") == F.col("other")).alias("one"),
        "bands",
    )

    def sorted_tiles(rows: DataFrame) -> DataFrame:
        return rows.repartition(*TILE).sortWithinPartitions(*TILE, "side", "node")

    fields = "bucket bigint, low bigint, high bigint, node bigint, label bigint, side int, one boolean"
    tested = scratch.keep(sorted_tiles(tiles).mapInArrow(_survivors(percent), fields), "tested")
    read = sorted_tiles(tested.join(texts, "node"))
    return read.mapInArrow(_tile_links(width, percent), "a bigint, b bigint").distinct()


def _judged(docs: DataFrame, width: int, percent: int, ident: str, text: str) -> DataFrame:
    """`id, mark, n, component, lead` of each row, the mark being a hash of the text; leads stay."""
    need_text(docs, ident, text)
    scratch = Scratch(docs.sparkSession, "near-dedup")
    docs = docs.select(F.col(ident).alias("id"), F.col(text).alias("text"))
    parts = shingle_columns("text", width)
    signed = docs.select("id", F.xxhash64("text").alias("mark"), parts.alias("s"))
    rows = scratch.keep(signed.select("id", "mark", "s.n", "s.key", "s.bands"), "rows")
    rows = rows.withColumn("anonymous", F.col("id").isNull())
    first = F.min(F.struct("id", "mark")).alias("first")
    classes = rows.where("key IS NOT NULL").groupBy("anonymous", "key", "n", "bands").agg(first)
    # two texts under one id are two classes, so a class has a number of its own, which holds once it is written
    nodes = scratch.keep(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = rows.select("id", "mark", "n", "anonymous", "key")

    exploded = nodes.select("node", "anonymous", F.posexplode("bands").alias("band", "mark"))
    buckets = exploded.select("node", F.xxhash64("anonymous", "band", "mark").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("m")).where("m > 1")
    members = scratch.keep(buckets.join(scratch.keep(hubs, "hubs"), "bucket"), "members")
    # in a bucket of two the one pair is judged by way of the hub
    crowded = members.where("m > 2").select("bucket", "node")
    pairs = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    signed = pairs.join(nodes.select(F.col("node").alias("a"), F.col("bands").alias("left")), "a").join(
        nodes.select(F.col("node").alias("b"), F.col("bands").alias("right")), "b"
    )
    alike = scratch.keep(signed.where(_alike(percent)("left", "right")).select("a", "b"), "alike")

    # texts are shuffled once, for all that may have to be verified
    needed = crowded.select("node").union(alike.select("a")).union(alike.select("b")).distinct()
    wanted = nodes.join(needed, "node").select("node", F.col("first.id").alias("of"), F.col("first.mark").alias("as"))
    found = docs.join(wanted, F.col("id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("as")))
    # rows that repeat id and text are one node
    texts = scratch.keep(found.groupBy("node").agg(F.first("text").alias("text")), "texts")
    links = scratch.keep(_verified(texts, alike, width, percent), "links")
    comps = scratch.keep(connected(scratch, links, "first"), "first")
    more = scratch.keep(_across(scratch, texts, nodes, crowded, comps, width, percent), "more")
    scratch.drop("members", "hubs", "mixed", "labels", "blocks", "tested", "texts")
    if not more.isEmpty():
        comps = scratch.keep(connected(scratch, links.union(more), "second"), "second")

    linked = nodes.select("node", "first").join(comps, "node")
    # what is known of a component is written before it joins its members, so that the join can split a large one
    lowest = scratch.keep(linked.groupBy("component").agg(F.min("first").alias("lowest")), "lowest")
    member = linked.join(lowest, "component").select("node", "lowest")
    classes = nodes.join(member, "node", "left").select("anonymous", "key", F.coalesce("lowest", "first").alias("lowest"))
    component = F.coalesce("lowest.id", "id").alias("component")
    lead = F.col("id").eqNullSafe(F.col("lowest.id")) & (F.col("mark") == F.col("lowest.mark"))
    stays = (F.col("key").isNull() | lead).alias("lead")
    return rows.join(classes, ["anonymous", "key"], "left").select("id", "mark", "n", component, stays)


def near_components(
    docs: DataFrame, width: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`ident, n_shingles, component_id, kept`, one row per row of `docs`."""
    return _judged(docs, width, percent, ident, text).select(
        F.col("id").alias(ident),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def near_dedup(
    docs: DataFrame, width: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of `docs` that stay, one of each component, with all their columns."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    judged = scratch.keep(_judged(docs, width, percent, ident, text), "judged")
    named = [F.col("id").alias("of"), F.col("mark").alias("as")]
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("as"))
    lost = judged.where("NOT lead").select(*named).distinct()
    again = judged.where("lead AND n > 0").groupBy("id", "mark").count().where("count > 1").select(*named)
    again = scratch.keep(again, "again")
    whole = docs.select(F.struct("*").alias("doc"), F.col(ident).alias("id"), F.xxhash64(text).alias("mark"))
    left = whole.join(lost, same, "left_anti")
    if again.isEmpty():
        return left.select("doc.*")
    # rows that repeat id and text shrink to one in each task before they are shuffled
    one = left.join(again, same, "left_semi").groupBy("id", "mark").agg(F.first("doc").alias("doc"))
    return left.join(again, same, "left_anti").select("doc.*").union(one.select("doc.*"))
