"""Vector code compression with per-dimension value dictionaries.

Vectors become integers floor(scale * x) and are cut into equal consecutive
parts; every part position has a codebook, fitted by rounds of integer k-means
that start at the parts of the smallest ids. A vector is then one codebook
index per part.

Vectors are written once in blocks. A block stores, for every dimension, its
distinct integers in order and each vector's place among them. A round
tabulates the squared difference of every distinct integer to all entries of
the dimension, so that the distance of a part is a gather and an addition per
dimension over dictionary codes, and no difference is computed twice. Per task
only counts and sums of the entries leave, entries x dimensions numbers.

All arithmetic is on integers and exact: where a distance may pass 63 bits, a
block is worked on with Python's integers.

Defined results: a vector that is NULL or holds a NULL or non-finite component
is left out. Equal distances go to the lower entry, unused entries stay. With
fewer vectors than entries the codebooks are as short. Seeds of equal id are
taken by the order of their vectors, a NULL id last. Repeated rows are vectors of their own.
Rows of NULL label share one error sum. Vectors of different widths, a width that
`parts` does not divide, and components beyond 2^50 are refused, for no result
could be right for them. An empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointflow.llm.tables import Scratch, need_columns

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# integers of a block, which bounds what a task holds of wide vectors
BLOCK_CELLS = 1 << 20
# beyond this no square fits a long
LARGEST = 2.0**62


def finite(vector: str | Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.coalesce(F.forall(column, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))


def integers(matrix: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(matrix * scale)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError("components are too large for exact squares")
    return scaled.astype(np.int64)


def dictionaries(values: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct integers of every dimension in order, and each vector's places in them."""
    codes = np.empty(values.shape, dtype=np.int32)
    words = []
    for d in range(values.shape[1]):
        word, codes[:, d] = np.unique(values[:, d], return_inverse=True)
        words.append(word)
    return words, codes


def part_distances(words: list[np.ndarray], codes: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(vectors, entries) squared distances over the dimensions given; `entries` is (entries, dimensions)."""
    most = max((int(np.abs(x).max()) for x in [*words, entries] if x.size), default=0)
    kind = np.int64 if len(words) * (2 * most) ** 2 < 2**63 else object
    total = np.zeros((len(codes), len(entries)), dtype=kind)
    for d, word in enumerate(words):
        gap = word.astype(kind)[:, None] - entries[:, d].astype(kind)[None, :]
        total += (gap * gap)[codes[:, d]]
    return total


def nearest(words: list[np.ndarray], codes: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, parts) indexes of the nearest entries, ties to the lower, and the vectors' squared errors."""
    parts, _, width = books.shape
    index = np.empty((len(codes), parts), dtype=np.int64)
    error = np.zeros(len(codes), dtype=object)
    for p in range(parts):
        own = slice(p * width, (p + 1) * width)
        distance = part_distances(words[own], codes[:, own], books[p])
        index[:, p] = distance.argmin(axis=1)
        error += distance[np.arange(len(codes)), index[:, p]]
    return index, error


def entry_sums(word: np.ndarray, codes: np.ndarray, index: np.ndarray, entries: int) -> list[int]:
    """Sums of one dimension's integers per entry, through how often each entry has each distinct integer."""
    pairs = np.bincount(index * len(word) + codes, minlength=entries * len(word)).reshape(entries, len(word))
    if len(codes) * int(np.abs(word).max()) < 2**63:
        return (pairs @ word).tolist()
    return [sum(int(n) * int(v) for n, v in zip(row, word) if n) for row in pairs]


def _blocks(dims: int, scale: int):
    def run(batches):
        rows = max(1, BLOCK_CELLS // max(1, dims))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                vectors = part.column("vector")
                if (np.diff(vectors.offsets.to_numpy()) != dims).any():
                    raise ValueError("vectors of different widths")
                matrix = vectors.flatten().to_numpy().reshape(part.num_rows, dims)
                words, codes = dictionaries(integers(matrix, scale))
                ends = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(ends, part.column("id")),
                        pa.ListArray.from_arrays(ends, part.column("label")),
                        pa.array([codes.tobytes()], pa.binary()),
                        pa.array([[w.tobytes() for w in words]], pa.list_(pa.binary())),
                    ],
                    names=["ids", "labels", "codes", "words"],
                )

    return run


def _opened(batch: pa.RecordBatch):
    """(row number, dictionaries, codes) of the blocks of a batch."""
    for i in range(batch.num_rows):
        words = [np.frombuffer(w, dtype=np.int64) for w in batch.column("words")[i].as_py()]
        codes = np.frombuffer(batch.column("codes")[i].as_py(), dtype=np.int32)
        n = len(batch.column("ids")[i])
        yield i, words, codes.reshape(n, len(words))


def _tallies(books: np.ndarray):
    parts, entries, width = books.shape

    def run(batches):
        n = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=object)
        for batch in batches:
            for _, words, codes in _opened(batch):
                index, _ = nearest(words, codes, books)
                for p in range(parts):
                    n[p] += np.bincount(index[:, p], minlength=entries)
                    for w in range(width):
                        d = p * width + w
                        sums[p, :, w] += np.array(entry_sums(words[d], codes[:, d], index[:, p], entries), dtype=object)
        p, e, w = np.indices(sums.shape).reshape(3, -1)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(p.astype(np.int32)),
                "entry": pa.array(e.astype(np.int32)),
                "at": pa.array(w.astype(np.int32)),
                "n": pa.array(n[p, e]),
                "total": pa.array([Decimal(int(x)) for x in sums.reshape(-1)], pa.decimal128(38, 0)),
            }
        )

    return run


def _encoded(books: np.ndarray, fields: list[str]):
    digits = np.array([f"{e:02x}" for e in range(books.shape[1])], dtype="S2")

    def run(batches):
        for batch in batches:
            for i, words, codes in _opened(batch):
                index, error = nearest(words, codes, books)
                text = np.ascontiguousarray(digits[index]).view(f"S{2 * books.shape[0]}").reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values,
                        batch.column("labels")[i].values,
                        pa.array(text.astype(str).tolist(), pa.string()),
                        pa.array([int(x) for x in error], pa.int64()),
                    ],
                    names=fields,
                )

    return run


def fit_codebooks(blocks: DataFrame, seeds: np.ndarray, rounds: int) -> np.ndarray:
    """(parts, entries, width) entries after the rounds; `seeds` are the first ones."""
    books = seeds
    for _ in range(rounds):
        found = blocks.select("ids", "codes", "words").mapInArrow(
            _tallies(books), "part int, entry int, at int, n long, total decimal(38,0)"
        )
        # as many rows as the codebooks have integers
        sums = found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        books = books.copy()
        for r in sums:
            if r["n"]:
                books[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return books


def codebooks_text(books: np.ndarray) -> str:
    """All integers of the entries by part, entry and position."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def compress_vectors(
    vectors: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """`ident, label, code, error, label_error`, one row per vector that is not left out, and the codebooks.

    `code` has two hex digits per part, `error` the squared distance to the
    entries named, `label_error` the sum over the vectors of equal label.
    """
    need_columns(vectors, ident, vector, label)
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: give 1 to 256 entries")
    scratch = Scratch(vectors.sparkSession, "codebooks")
    rows = vectors.where(finite(vector)).select(
        F.col(ident).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    dims = len(first[0]["vector"]) if first else 0
    if any(len(r["vector"]) != dims for r in first):
        raise ValueError("vectors of different widths")
    if dims % parts:
        raise ValueError(f"vectors of {dims} components have no {parts} equal parts")
    seeds = integers(np.array([r["vector"] for r in first], dtype=float).reshape(len(first), dims), scale)
    books = np.ascontiguousarray(seeds.reshape(len(first), parts, dims // parts).transpose(1, 0, 2))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    blocks = scratch.keep(
        rows.mapInArrow(
            _blocks(dims, scale),
            f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, codes binary, words array<binary>",
        ),
        "blocks",
    )
    books = fit_codebooks(blocks, books, rounds)
    fields = ["id", "label", "code", "error"]
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    coded = scratch.keep(blocks.mapInArrow(_encoded(books, fields), schema), "coded")
    # written before it joins its own rows, so that the join can split a label with very many of them
    sums = scratch.keep(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    joined = coded.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    out = joined.select(F.col("c.id").alias(ident), F.col("c.label").alias(label), "c.code", "c.error", "s.label_error")
    return out, books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(codebooks_text(books).encode()).hexdigest()
