"""Embedding near-dedup by tile products of int8 vectors with rigorous error bounds.

Vectors are compared within their label only. Equal vectors form a class first.
A label's classes are dealt into blocks of about BLOCK_VECTORS; each pair of
blocks is a tile, the unit of work, however many vectors a label has. In a tile
every unit vector u is written as s q + e with q in int8. With v = t r + f,

    |u.v - s t q.r| <= |s q| |f| + |e| |t r| + |e| |f|,

so the integer product q.r decides all pairs whose bound stays below the
threshold; only the others are computed again in double precision. A tile
returns its vectors' link counts and a spanning forest of its links, never the
pairs.

The products are exact: float32 holds sums of products of int8 up to 2^24, and
wider vectors are multiplied in strips of 1,024 components.

Defined results: a vector that is NULL, empty, zero, or holds a NULL or
non-finite component, and one whose label or id is NULL, links with nothing and
is kept. Vectors of different lengths do not link. Repeated rows are vectors of
their own. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointflow.llm.components import connected, forest
from pointflow.llm.tables import Scratch, need_columns

BLOCK_VECTORS = 1024
STRIP = 1024
# pairs that are computed again at a time
RECHECK_PAIRS = 1 << 16
# slack for the rounding of the bound itself, far below the threshold's digits
ROUNDING = 1e-9


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scales, and the lengths of the quantised vectors and of what they leave out."""
    scale = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    shown = codes * scale[:, None]
    left = units - shown
    return codes, scale, np.sqrt((shown * shown).sum(axis=1)), np.sqrt((left * left).sum(axis=1))


def code_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    total = np.zeros((len(left), len(right)))
    for at in range(0, left.shape[1], STRIP):
        strip = slice(at, at + STRIP)
        total += left[:, strip].astype(np.float32) @ right[:, strip].astype(np.float32).T
    return total


def links_between(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit rows whose cosine reaches the threshold."""
    codes_l, scale_l, shown_l, left_l = quantise(left)
    codes_r, scale_r, shown_r, left_r = quantise(right)
    near = code_products(codes_l, codes_r) * scale_l[:, None] * scale_r[None, :]
    bound = np.outer(shown_l, left_r) + np.outer(left_l, shown_r) + np.outer(left_l, left_r) + ROUNDING
    i, j = np.nonzero(near + bound >= threshold)
    stay = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), RECHECK_PAIRS):
        part = slice(at, at + RECHECK_PAIRS)
        stay[part] = np.einsum("ij,ij->i", left[i[part]], right[j[part]]) >= threshold
    return i[stay], j[stay]


def _tile(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        first = rows.column("side").to_numpy() == 0
        vectors = rows.column("vector").chunk(0).flatten().to_numpy().astype(np.float64)
        units = unit_rows(vectors.reshape(len(ids), -1))
        if rows.column("one")[0].as_py():
            i, j = links_between(units, units, threshold)
            i, j = i[i < j], j[i < j]
        else:
            a, b = np.flatnonzero(first), np.flatnonzero(~first)
            i, j = links_between(units[a], units[b], threshold)
            i, j = a[i], b[j]
        links = np.bincount(i, copies[j], minlength=len(ids)) + np.bincount(j, copies[i], minlength=len(ids))
        used = np.flatnonzero(links)
        return pa.table(
            {
                "rep": pa.array(ids[used]),
                "links": pa.array(links[used].astype(np.int64)),
                "root": pa.array(ids[forest(len(ids), i, j)][used]),
            }
        )

    return run


def usable(vector: str | Column) -> Column:
    """Whether a vector has a direction: it is not NULL or zero and all its components are finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(column, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def cosine_links(
    vectors: DataFrame,
    threshold: float = 0.93,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    block: int = BLOCK_VECTORS,
) -> DataFrame:
    """`ident, n_links, component_id, kept`, one row per row of `vectors`."""
    need_columns(vectors, ident, vector, label)
    scratch = Scratch(vectors.sparkSession, "int8-tiles")
    rows = vectors.select(F.col(ident).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    fit = usable("vector") & F.col("label").isNotNull() & F.col("id").isNotNull()
    classes = rows.where(fit).groupBy("label", "vector").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    # two vectors under one id are two classes, so a class has a number of its own, which holds once it is written
    named = scratch.keep(classes.withColumn("rep", F.monotonically_increasing_id()), "named")
    width = F.size("vector").alias("width")
    # what is known of a group is written before it joins its members, so that the join can split a hot group
    sizes = scratch.keep(named.groupBy("label", width).agg(F.ceil(F.count("*") / block).alias("blocks")), "sizes")
    placed = named.withColumn("width", F.size("vector")).join(sizes, ["label", "width"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    tiles = placed.select("rep", "label", "vector", "copies", "width", "block", other).select(
        "rep",
        "label",
        "vector",
        "copies",
        "width",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        (F.col("block") == F.col("other")).alias("one"),
    )
    found = tiles.groupBy("label", "width", "low", "high").applyInArrow(
        _tile(threshold), "rep bigint, links bigint, root bigint"
    )
    found = scratch.keep(found, "found")
    comps = connected(scratch, found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = named.select("rep", "first").join(comps.withColumnRenamed("node", "rep"), "rep")
    lowest = scratch.keep(linked.groupBy("component").agg(F.min("first").alias("component_id")), "lowest")
    member = linked.join(lowest, "component").select("rep", "component_id")
    judged = named.join(totals, "rep", "left").join(member, "rep", "left")
    judged = judged.select(
        "label",
        "vector",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "first").alias("component_id"),
    )
    keyed = rows.withColumn("fit", fit)
    same = (keyed["fit"]) & (keyed["label"] == judged["label"]) & (keyed["vector"] == judged["vector"])
    result = keyed.join(judged, same, "left")
    component = F.coalesce("component_id", "id")
    return result.select(
        F.col("id").alias(ident),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
