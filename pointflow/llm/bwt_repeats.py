"""Suffix-array dedup: repeated strings by threshold-bounded interval expansion.

A byte is cut if it lies in a string of `length` bytes that also starts earlier
in the corpus. Equal strings are found on Burrows-Wheeler transforms: from the
interval of the empty string, every interval is extended backwards by each byte
that occurs in it, breadth first, and an extension whose right end has no value
yet sets the common prefix there to its depth. Values so come in increasing
order and the expansion stops at `length`; places without a value by then
separate nothing, so the suffixes between two values begin with equal strings.

No transform holds the corpus. All windows of `length` bytes are dealt into
segments: a window belongs to the GRAM bytes in it whose hash is least (the
leftmost of equals), and neighbouring windows of one such gram make a segment.
Equal windows choose the same gram, so they meet under its hash:

1. Grams that occur once in the corpus hold no repeated window and go, by a
   count with a map-side part.
2. Segments equal as a whole (128-bit digests) are counted as one at its earliest
   place; at all its other places it is cut whole.
3. Grams with several kinds of segments are shuffled with the segments' bytes, one
   place each, and transforms over runs of such grams find the windows they share.
   A gram with more than MAX_KINDS kinds would not fit into one: its segments
   are dealt again into segments of a single window each, which step 2 settles.

Places are ordered by document id (NULL last), documents of one id by a hash of
their text, and then by start. Texts are UTF-8 bytes, NULL is empty.

Defined results: strings never cross documents; overlaps within a document count.
Rows that repeat id and text are at equal places, of which neither is earlier,
so they leave each other alone. Texts shorter than `length` keep all bytes. An
empty table gives an empty result. Very long texts are read whole. Other columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointflow.llm.shingles import mix
from pointflow.llm.tables import Scratch, batch_slices, give_back, need_text, text_slices

LENGTH = 100
GRAM = 32
# segments of one gram that a transform takes
MAX_KINDS = 4096
# bytes of a transform, which fits a cache; the segments of a gram stay together
CHUNK_BYTES = 1 << 16
_BASE = 0x9E3779B97F4A7C15
# bytes that are hashed at a time; longer texts are taken in overlapping stretches
STRETCH = 1 << 19
# symbols of 9 bits that fit a word: 256 bytes and the end of a segment
_WORD = 7


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit polynomial hash of the `gram` bytes from every place on."""
    n = len(data)

    def joined(a, wide_a, b, wide_b):
        m = n - wide_a - wide_b + 1
        return a[:m] * np.uint64(pow(_BASE, wide_b, 1 << 64)) + b[wide_a : wide_a + m]

    power, wide = data.astype(np.uint64) + np.uint64(1), 1
    total, done = None, 0
    while True:
        if gram & wide:
            total, done = (power, wide) if total is None else (joined(total, done, power, wide), done + wide)
        if 2 * wide > gram:
            return total
        power, wide = joined(power, wide, power, wide), 2 * wide


def segments_of(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, stop, hash of the gram) of the segments that hold all windows of the texts.

    The memory needed depends on STRETCH and not on the texts. A segment that
    passes the end of a stretch becomes two; each window still is in one.
    """
    found = [(np.empty(0, dtype=np.int64),) * 4]
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for d, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, STRETCH):
            part = text[at : at + STRETCH + length - 1]
            if size + len(part) > STRETCH and held:
                found.append(_segments_in(held, length, gram))
                held, size = [], 0
            held.append((d, at, part))
            size += len(part)
    if held:
        found.append(_segments_in(held, length, gram))
    return tuple(np.concatenate(x) for x in zip(*found))


def _segments_in(parts: list[tuple[int, int, bytes]], length: int, gram: int):
    """The segments of some texts' parts, each of at least `length` bytes and told with its text and start."""
    owner, base = (np.array([p[i] for p in parts], dtype=np.int64) for i in (0, 1))
    sizes = np.array([len(p[2]) for p in parts], dtype=np.int64)
    offsets = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(p[2] for p in parts), dtype=np.uint8)
    hashes = gram_hashes(data, gram)
    # the place in the low half, so that the least value is the leftmost of the least hashes
    least = (mix(hashes) >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    wide, grams = 1, length - gram + 1
    while 2 * wide <= grams:
        least, wide = np.minimum(least[:-wide], least[wide:]), 2 * wide
    if wide < grams:
        least = np.minimum(least[: len(least) - grams + wide], least[grams - wide :])
    windows = sizes - length + 1
    part = np.repeat(np.arange(len(parts)), windows)
    start = np.arange(len(part)) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[part]
    anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # grams lie inside their part, so a new part has a new gram
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(new[1:], len(start)) - 1
    shift = base[part[new]] - offsets[part[new]]
    return owner[part[new]], start[new] + shift, start[last] + shift + length, hashes[anchor[new]].view(np.int64)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` symbols at least, by tripling where three ranks fit a word, else doubling."""
    n = len(symbols)
    times = 3 if (n + 1) ** 3 < 1 << 63 else 2
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(_WORD, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for j in range(_WORD):
        key = (key << 9) | padded[j : j + n]
    sorted_to = _WORD
    while True:
        order = np.argsort(key)
        if sorted_to >= depth:
            return order
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.diff(ranked, prepend=ranked[0]) != 0) + 1
        key = rank
        for _ in range(times - 1):
            # the ranks of what follows, 0 beyond the end
            rank = np.concatenate([rank[sorted_to:], np.zeros(min(n, sorted_to), dtype=np.int64)])
            key = key * (n + 1) + rank
        sorted_to *= times


def shorter_prefixes(bwt: np.ndarray, length: int) -> np.ndarray:
    """Per place of the suffix array, whether the common prefix with the place before is shorter than `length`.

    Symbol 0 ends a segment and is not extended over, so places between
    suffixes that differ only beyond an end may stay without a value.
    """
    n = len(bwt)
    by_symbol = np.argsort(bwt, kind="stable")
    front = np.empty(n, dtype=np.int64)
    front[by_symbol] = np.arange(n)
    same = np.flatnonzero(bwt[by_symbol[1:]] == bwt[by_symbol[:-1]])
    before, after = np.full(n, -1), np.full(n, n)
    before[by_symbol[same + 1]] = by_symbol[same]
    after[by_symbol[same]] = by_symbol[same + 1]
    valued = np.zeros(n + 1, dtype=bool)
    valued[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for depth in range(length):
        size = high - low
        at = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        if depth:
            inside = bwt[at] != 0
        else:
            inside = np.ones(n, dtype=bool)
        # the first and the last place of every symbol in an interval are the ends of its extension
        first = at[inside & (before[at] < np.repeat(low, size))]
        last = at[inside & (after[at] >= np.repeat(high, size))]
        low, high = np.sort(front[first]), np.sort(front[last]) + 1
        fresh = ~valued[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        valued[high] = True
    return valued[:n]


def window_classes(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start, class) of all windows of the pieces in order; equal windows have one class."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    data = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
    symbols = data.astype(np.uint16) + np.uint16(1)
    offsets = np.cumsum(sizes + 1) - sizes - 1
    symbols[offsets + sizes] = 0
    order = suffix_order(symbols, length)
    classes = np.empty(len(symbols), dtype=np.int64)
    classes[order] = np.cumsum(shorter_prefixes(symbols[order - 1], length))
    windows = np.maximum(sizes - length + 1, 0)
    piece = np.repeat(np.arange(len(pieces)), windows)
    start = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    return piece, start, classes[offsets[piece] + start]


def later_runs(pieces: list[bytes], places: list[tuple], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start, stop) of the runs of windows that also start at an earlier place; a place is (id, mark, start)."""
    piece, start, klass = window_classes(pieces, length)
    order = {d: i for i, d in enumerate(sorted({p[:2] for p in places}, key=lambda d: (d[0] is None, *d)))}
    doc = np.array([order[p[:2]] for p in places], dtype=np.int64)
    first = np.array([p[2] for p in places], dtype=np.int64)
    place = (doc[piece] << 32) + first[piece] + start
    by_class = np.lexsort((place, klass))
    heads = np.flatnonzero(np.diff(klass[by_class], prepend=-1))
    earliest = np.empty(len(place), dtype=np.int64)
    earliest[by_class] = np.repeat(place[by_class][heads], np.diff(np.append(heads, len(place))))
    later = np.flatnonzero(place != earliest)
    ends = np.diff(later, prepend=-2) != 1
    ends |= np.diff(piece[later], prepend=-1) != 0
    head = np.flatnonzero(ends)
    last = later[np.append(head[1:], len(later)) - 1] if len(head) else later
    head = later[head]
    return piece[head], start[head], start[last] + length


def _gram_counts(length: int, gram: int):
    def run(batches):
        for texts in text_slices(b.column("text") for b in batches):
            key, n = np.unique(segments_of(texts, length, gram)[3], return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": pa.array(key, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def _slices(batches, columns: list[str]):
    """The texts of all batches in slices, with the rows of the other columns that belong to them."""
    for batch in batches:
        row = 0
        for texts in batch_slices(batch.column("text")):
            yield texts, [batch.column(c).slice(row, len(texts)) for c in columns]
            row += len(texts)
    give_back()


def _digests(texts: list[bytes], doc, start, stop) -> np.ndarray:
    """128 bits for each segment, as two integers."""
    made = (hashlib.blake2b(texts[d][a:b], digest_size=16).digest() for d, a, b in zip(doc.tolist(), start.tolist(), stop.tolist()))
    return np.frombuffer(b"".join(made), dtype=np.int64).reshape(-1, 2)


def _segments(length: int, gram: int):
    """Rows of segments; `base` is where a text starts in its document."""

    def run(batches):
        for texts, (ids, marks, bases) in _slices(batches, ["id", "mark", "base"]):
            doc, start, stop, key = segments_of(texts, length, gram)
            digest = _digests(texts, doc, start, stop)
            base = bases.to_numpy(zero_copy_only=False)[doc]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    ids.take(pa.array(doc)),
                    marks.take(pa.array(doc)),
                    pa.array(base + start),
                    pa.array(base + stop),
                ],
                names=["key", "a", "b", "id", "mark", "start", "stop"],
            )

    return run


def _pieces(batches):
    """The bytes of the wanted segments of each document."""
    for texts, (ids, marks, wanted) in _slices(batches, ["id", "mark", "wanted"]):
        rows = [(d, w["key"], w["start"], w["many"], t[w["start"] : w["stop"]]) for d, (t, ws) in enumerate(zip(texts, wanted.to_pylist())) for w in ws]
        doc, key, start, many, piece = zip(*rows) if rows else ((), (), (), (), ())
        take = pa.array(doc, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), ids.take(take), marks.take(take), pa.array(start, pa.int64()), pa.array(many, pa.bool_()), pa.array(piece, pa.binary())],
            names=["key", "id", "mark", "start", "many", "piece"],
        )


def _expanded(length: int):
    """Runs of later windows in the segments of each gram; rows come in the order of their grams."""

    def found(pieces, places, kind):
        piece, start, stop = later_runs(pieces, places, length)
        own = [places[i] for i in piece.tolist()]
        first = np.array([p[2] for p in own], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in own], kind), pa.array([p[1] for p in own], pa.int64()), pa.array(first + start), pa.array(first + stop)],
            names=["id", "mark", "start", "stop"],
        )

    def run(batches):
        pieces, places, held, last = [], [], 0, None
        for batch in batches:
            kind = batch.schema.field("id").type
            for key, *place, piece in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "mark", "start", "piece"))):
                if last == (key, *place):
                    continue
                if held >= CHUNK_BYTES and key != last[0]:
                    yield found(pieces, places, kind)
                    pieces, places, held = [], [], 0
                pieces.append(piece)
                places.append(tuple(place))
                held += len(piece)
                last = (key, *place)
        if pieces:
            yield found(pieces, places, kind)

    return run


def _cut(batches):
    """What is left of each text without its spans."""
    for texts, (ids, spans) in _slices(batches, ["id", "spans"]):
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for text, own in zip(texts, spans.to_pylist()):
            out, at, runs, removed = [], 0, 0, 0
            end = -1
            for start, stop in sorted((s["start"], s["stop"]) for s in own or ()):
                if start > end:
                    runs += 1
                    out.append(text[at:start])
                    end = start
                if stop > end:
                    removed += stop - end
                    end = at = stop
            out.append(text[at:])
            n_bytes.append(len(text))
            n_removed.append(removed)
            n_spans.append(runs)
            kept.append(b"".join(out))
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _place() -> Column:
    """What places are ordered by."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "mark", "start", "stop")


def _later_copies(scratch: Scratch, segments: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Kinds of segments `key, a, b, n, first`, and `id, mark, start, stop` of the segments that are not the first of their kind."""
    kinds = scratch.keep(segments.groupBy("key", "a", "b").agg(F.min(_place()).alias("first"), F.count("*").alias("n")), name)
    again = segments.join(kinds.where("n > 1").select("key", "a", "b", "first"), ["key", "a", "b"])
    return kinds, again.where(_place() != F.col("first")).select("id", "mark", "start", "stop")


def _at(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join what belongs to one document."""
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.mark") == F.col("r.mark"))
    others = [F.col(f"r.{c}") for c in right.columns if c not in ("id", "mark")]
    return left.alias("l").join(right.alias("r"), same, how).select("l.*", *others)


def repeated_spans(
    scratch: Scratch, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_kinds: int = MAX_KINDS
) -> DataFrame:
    """`id, mark, start, stop` of byte runs that also start earlier, for `docs(id, mark, text)`; runs may overlap."""
    kind = docs.schema["id"].dataType
    segment = f"key long, a long, b long, id {kind.simpleString()}, mark long, start long, stop long"
    whole = docs.withColumn("base", F.lit(0).cast("long"))
    counts = docs.select("text").mapInArrow(_gram_counts(length, gram), "key long, n long")
    repeated = scratch.keep(counts.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"), "grams")
    segments = scratch.keep(whole.mapInArrow(_segments(length, gram), segment).join(repeated, "key", "left_semi"), "segments")
    kinds, copies = _later_copies(scratch, segments, "kinds")

    several = scratch.keep(kinds.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1"), "several")
    wanted = kinds.join(several, "key").select(
        "first.id",
        "first.mark",
        F.struct("key", "first.start", "first.stop", (F.col("kinds") > max_kinds).alias("many")).alias("w"),
    )
    # as many as a document has grams
    wanted = scratch.keep(wanted.groupBy("id", "mark").agg(F.collect_list("w").alias("wanted")), "wanted")
    pieces = _at(docs, wanted, "inner").mapInArrow(
        _pieces, f"key long, id {kind.simpleString()}, mark long, start long, many boolean, piece binary"
    )
    pieces = scratch.keep(pieces, "pieces")
    few = pieces.where("NOT many").repartition("key").sortWithinPartitions("key", "id", "mark", "start")
    shared = few.mapInArrow(_expanded(length), f"id {kind.simpleString()}, mark long, start long, stop long")

    crowded = pieces.where("many").select("id", "mark", F.col("piece").alias("text"), F.col("start").alias("base"))
    single = scratch.keep(crowded.mapInArrow(_segments(length, length), segment), "windows")
    _, windows = _later_copies(scratch, single, "window-kinds")
    return copies.union(shared).union(windows)


def cut_repeats(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    max_kinds: int = MAX_KINDS,
) -> DataFrame:
    """`ident, n_bytes, n_removed, n_spans, kept`, one row per row of `docs`; `kept` is what is left of the bytes."""
    if not 1 <= gram <= length:
        raise ValueError("a gram has 1 to `length` bytes")
    need_text(docs, ident, text)
    scratch = Scratch(docs.sparkSession, "repeats")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(ident).alias("id"), F.xxhash64(body).alias("mark"), body.alias("text"))
    spans = repeated_spans(scratch, rows, length, gram, max_kinds)
    spans = spans.groupBy("id", "mark", "start").agg(F.max("stop").alias("stop"))
    spans = spans.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = _at(rows, scratch.keep(spans, "spans"), "left")
    kind = rows.schema["id"].dataType.simpleString()
    out = cut.mapInArrow(_cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", ident)
