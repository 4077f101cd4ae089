"""Source divergence audit over a minimal acyclic transducer vocabulary.

A term is a run of ASCII letters and characters beyond ASCII, A-Z lowered. Each
language keeps the terms that enough of its documents hold. From them, sorted,
a minimal acyclic transducer is built: states with equal futures are one, and
the numbers on the arcs of a path add up to the term's ordinal, its rank in
lexicographic order. The keys are language, a zero byte and term, so one
transducer serves all languages and the ordinals of a language are in a row and
in term order. All texts are then streamed through it byte by byte, all terms of a slice
at a time, which recounts the kept terms of every source without a dictionary of
strings; from there on a term is its ordinal, which also breaks ties.

Sources are compared over their shares p, integers in billionths. The value of a
pair needs every kept term, also those that neither has, so pairs are computed
in tiles: a block of sources against another over a range of ordinals, dense
inside the task. A tile returns one number per pair; terms never pair up.

The transducer is broadcast, so its keys are counted before: beyond MAX_KEY_BYTES
a shuffled join of counted terms with the kept ones takes its place.

Defined results: NULL text, language and source count as ''. A source without
terms is a group as well. A language without kept terms gives its pairs the
value 0 and no term rows. Repeated rows are documents of their own. An empty
table gives an empty result. Very long texts and terms are read whole. Other columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointflow.llm.tables import Scratch, batch_slices, give_back, need_text

MIN_DOCS = 10
TOP_TERMS = 10
BILLION = 1_000_000_000
# bytes of all keys up to which the transducer is built in one task and broadcast; an arc takes 20 bytes at most
MAX_KEY_BYTES = 8 << 20
# counted terms that a task holds before it hands them on
HELD_TERMS = 1 << 18
# counted ordinals that a task holds, in 16 bytes each; ordinals are fewer than the bytes of all keys
HELD_CELLS = 1 << 20
ORDINAL_BITS = 40
# a tile is two blocks of about so many sources over so many ordinals
BLOCK_SOURCES = 128
BLOCK_TERMS = 1024

# bytes of terms, A-Z as a-z; all others become blanks
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class Transducer(NamedTuple):
    """Arcs sorted by state and byte; state 0 is the root."""

    arcs: np.ndarray  # state * 256 + byte
    to: np.ndarray  # the state that an arc leads to
    add: np.ndarray  # accepted keys that sort before every key through this arc
    final: np.ndarray  # per state, whether a key ends there

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arcs taken, and whether there is one."""
        want = state * 256 + byte
        at = np.searchsorted(self.arcs, want)
        at[at == len(self.arcs)] = 0
        return at, self.arcs[at] == want if len(self.arcs) else np.zeros(len(want), dtype=bool)

    def walk(self, key: bytes) -> tuple[int, int] | None:
        """State and ordinal so far after the bytes of one key, or None."""
        state, ordinal = 0, 0
        for byte in key:
            at, there = self.step(np.array([state]), np.array([byte]))
            if not there[0]:
                return None
            state, ordinal = int(self.to[at[0]]), ordinal + int(self.add[at[0]])
        return state, ordinal


def build_transducer(keys: Iterable[bytes]) -> Transducer:
    """From sorted distinct keys; a state is frozen, or found among the frozen ones, once no key can change it."""
    frozen: dict[tuple, int] = {}
    shapes: list[tuple] = []

    def freeze(arcs: list[tuple[int, int]], final: bool) -> int:
        shape = (final, tuple(arcs))
        number = frozen.setdefault(shape, len(shapes))
        if number == len(shapes):
            shapes.append(shape)
        return number

    # the states along the last key: [arcs to frozen states, whether a key ends here]
    path: list[list] = [[[], False]]
    last = b""
    for key in keys:
        common = 0
        while common < min(len(key), len(last)) and key[common] == last[common]:
            common += 1
        for depth in range(len(last), common, -1):
            done = path.pop()
            path[-1][0].append((last[depth - 1], freeze(*done)))
        path += [[[], False] for _ in range(len(key) - common)]
        path[-1][1] = True
        last = key
    for depth in range(len(last), 0, -1):
        done = path.pop()
        path[-1][0].append((last[depth - 1], freeze(*done)))
    root = freeze(*path[0])

    # frozen states come before those that lead to them, so counts go forward and numbers are turned round
    below = [0] * len(shapes)
    arcs, to, add = [], [], []
    for number, (final, out) in enumerate(shapes):
        total = int(final)
        for byte, state in out:
            arcs.append((root - number) * 256 + byte)
            to.append(root - state)
            add.append(total)
            total += below[state]
        below[number] = total
    order = np.argsort(np.array(arcs, dtype=np.int64), kind="stable")
    return Transducer(
        np.array(arcs, dtype=np.int64)[order],
        np.array(to, dtype=np.int64)[order],
        np.array(add, dtype=np.int64)[order],
        np.array([final for final, _ in reversed(shapes)], dtype=bool),
    )


def pack(transducer: Transducer) -> list[bytes]:
    return [a.tobytes() for a in transducer]


def unpack(parts: list[bytes]) -> Transducer:
    kinds = (np.int64, np.int64, np.int64, np.bool_)
    return Transducer(*(np.frombuffer(p, dtype=k) for p, k in zip(parts, kinds)))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split()


def stream_ordinals(transducer: Transducer, text: bytes, starts: np.ndarray, owner: np.ndarray, entries: list) -> tuple:
    """Run all terms of `text` at once: (owner, ordinal) of those that the transducer accepts.

    `text` has blanks between terms; `owner` says whose document each term
    belongs to, and `entries` where an owner's terms enter the transducer.
    """
    data = np.frombuffer(text + b" ", dtype=np.uint8)
    state = np.array([e[0] if e else -1 for e in entries], dtype=np.int64)[owner]
    total = np.array([e[1] if e else 0 for e in entries], dtype=np.int64)[owner]
    alive = state >= 0
    at, state, total, owner = starts[alive], state[alive], total[alive], owner[alive]
    owners, ordinals = [], []
    while len(at):
        byte = data[at]
        ended = byte == 32
        accepted = ended & transducer.final[state]
        owners.append(owner[accepted])
        ordinals.append(total[accepted])
        on = np.flatnonzero(~ended)
        arc, there = transducer.step(state[on], byte[on].astype(np.int64))
        on, arc = on[there], arc[there]
        at, state, total, owner = at[on] + 1, transducer.to[arc], total[on] + transducer.add[arc], owner[on]
    if not owners:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(owners), np.concatenate(ordinals)


def key_of(lang: str, term: bytes = b"") -> bytes:
    """Language, a zero byte and term.

    Zero bytes of a language are written as others, so that no language with the zero byte
    begins another one's keys and the ordinals of each are in a row, whatever it is called.
    """
    return lang.replace("\1", "\1\2").replace("\0", "\1\1").encode("utf-8", "replace") + b"\0" + term


def _lang_key() -> Column:
    """What `key_of` makes of a language, without the zero byte."""
    return F.replace(F.replace(F.col("lang"), F.lit("\1"), F.lit("\1\2")), F.lit("\0"), F.lit("\1\1"))


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _tally(columns: list[str], per_document: bool):
    """Counts of terms per group, of documents that hold them or of all their occurrences."""

    def emit(counts):
        groups, terms, n = [], [], []
        for group, tally in counts.items():
            groups += [group] * len(tally)
            terms += [t.decode("utf-8") for t in tally]
            n += tally.values()
        arrays = [pa.array([g[i] for g in groups], pa.string()) for i in range(len(columns))]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(terms, pa.string()), pa.array(n, pa.int64())], names=[*columns, "term", "n"]
        )

    def run(batches):
        counts: dict[tuple, Counter] = {}
        held = 0
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in columns))
            for texts in batch_slices(batch.column("text")):
                for text in texts:
                    terms = terms_of(text)
                    tally = counts.setdefault(next(keys), Counter())
                    before = len(tally)
                    tally.update(set(terms) if per_document else terms)
                    held += len(tally) - before
                    if held > HELD_TERMS:
                        yield emit(counts)
                        counts, held = {}, 0
        yield emit(counts)
        give_back()

    return run


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """`lang, term` of every term that at least so many documents of the language hold."""
    found = docs.select("lang", "text").mapInArrow(_tally(["lang"], True), "lang string, term string, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")


def _built(batches):
    """One row: the transducer of the sorted keys of the task's rows."""
    keys = (key for batch in batches for key in batch.column("key").to_pylist())
    yield pa.RecordBatch.from_pydict({"parts": pa.array([pack(build_transducer(keys))], pa.list_(pa.binary()))})


class Tallies:
    """Counts of (group, ordinal), held as sorted arrays of at most HELD_CELLS cells."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.cells = 0

    def add(self, group: np.ndarray, ordinal: np.ndarray) -> None:
        cell, n = np.unique(group << ORDINAL_BITS | ordinal, return_counts=True)
        self.parts.append((cell, n))
        self.cells += len(cell)

    def full(self) -> bool:
        """Whether there are too many cells, equal ones added up, to go on."""
        if self.cells <= HELD_CELLS:
            return False
        self.parts = [self.merged()]
        self.cells = len(self.parts[0][0])
        return self.cells > HELD_CELLS // 2

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        empty = np.empty(0, dtype=np.int64)
        cell, n = (np.concatenate([empty, *x]) for x in zip(*self.parts)) if self.parts else (empty, empty)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        heads = np.flatnonzero(np.diff(cell, prepend=-1))
        return cell[heads], np.add.reduceat(n[order], heads) if len(heads) else empty


def _recount(shared):
    """Counts per language, source and ordinal of a task's texts, and a row without ordinal for every group seen."""

    def emit(groups, told, tallies):
        cell, n = tallies.merged()
        fresh = np.arange(told, len(groups))
        group = np.concatenate([fresh, cell >> ORDINAL_BITS])
        ordinal = np.concatenate([fresh, cell & ((1 << ORDINAL_BITS) - 1)])
        names = [pa.array([g[i] for g in groups], pa.string()).take(pa.array(group)) for i in (0, 1)]
        known = np.arange(len(group)) < len(fresh)
        counts = np.concatenate([np.zeros(len(fresh), dtype=np.int64), n])
        return pa.RecordBatch.from_arrays([*names, pa.array(ordinal, mask=known), pa.array(counts)], names=["lang", "source", "ordinal", "n"])

    def run(batches):
        transducer = unpack(shared.value)
        entry: dict[str, tuple | None] = {}
        # groups of the task in the order in which they were met, and how many of them were told
        number: dict[tuple, int] = {}
        told, tallies = 0, Tallies()
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            row = 0
            for texts in batch_slices(batch.column("text")):
                groups = list(zip(langs[row : row + len(texts)], sources[row : row + len(texts)]))
                row += len(texts)
                for lang, _ in groups:
                    if lang not in entry:
                        entry[lang] = transducer.walk(key_of(lang))
                own = np.array([number.setdefault(g, len(number)) for g in groups], dtype=np.int64)
                raw = [t.encode("utf-8", "replace") for t in texts]
                text = b" ".join(raw).translate(_TABLE)
                inside = np.frombuffer(text, dtype=np.uint8) != 32
                starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
                first = np.cumsum([0, *(len(t) + 1 for t in raw)])[:-1]
                doc = np.searchsorted(first, starts, side="right") - 1
                who, which = stream_ordinals(transducer, text, starts, doc, [entry[g[0]] for g in groups])
                tallies.add(own[who], which)
                if tallies.full():
                    yield emit(list(number), told, tallies)
                    told, tallies = len(number), Tallies()
        yield emit(list(number), told, tallies)
        give_back()

    return run


def _ordinals(shared):
    """The ordinals of kept terms, all terms of a batch at once."""

    def run(batches):
        transducer = unpack(shared.value)
        entry: dict[str, tuple | None] = {}
        for batch in batches:
            langs, terms = (batch.column(c).to_pylist() for c in ("lang", "term"))
            for lang in set(langs) - set(entry):
                entry[lang] = transducer.walk(key_of(lang))
            raw = [t.encode("utf-8") for t in terms]
            starts = np.cumsum([0, *(len(t) + 1 for t in raw)])[:-1]
            who, which = stream_ordinals(transducer, b" ".join(raw), starts, np.arange(len(raw)), [entry[x] for x in langs])
            ordinal = np.empty(len(raw), dtype=np.int64)
            ordinal[who] = which
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("term"), pa.array(ordinal)], names=["lang", "term", "ordinal"])

    return run


def count_kept(scratch: Scratch, docs: DataFrame, kept: DataFrame, max_key_bytes: int) -> tuple[DataFrame, DataFrame]:
    """`lang, term, ordinal` of the kept terms, and `lang, source, ordinal, n` with one more row, n = 0, per group."""
    key = F.concat(_lang_key().cast("binary"), F.unhex(F.lit("00")), F.col("term").cast("binary")).alias("key")
    keyed = kept.select("lang", "term", key)
    size = keyed.agg(F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()[0]
    if size <= max_key_bytes:
        sorted_keys = keyed.select("key").repartition(1).sortWithinPartitions("key")
        built = sorted_keys.mapInArrow(_built, "parts array<binary>").first()
        # without any key there is no task
        parts = [bytes(p) for p in built["parts"]] if built else pack(build_transducer(()))
        shared = docs.sparkSession.sparkContext.broadcast(parts)
        vocabulary = scratch.keep(keyed.select("lang", "term").mapInArrow(_ordinals(shared), "lang string, term string, ordinal long"), "vocabulary")
        found = docs.mapInArrow(_recount(shared), "lang string, source string, ordinal long, n long")
        return vocabulary, scratch.keep(found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "counts")
    # ranges of terms are numbered one after the other, and ranges are as many as partitions
    ranged = scratch.keep(keyed.repartitionByRange("key").sortWithinPartitions("key").withColumn("at", F.monotonically_increasing_id()), "ranged")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(F.shiftright("at", 33).alias("range"))
        .agg(F.count("*").alias("n"))
        .select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = F.col("at").bitwiseAND((1 << 33) - 1)
    placed = ranged.withColumn("range", F.shiftright("at", 33)).join(offsets, "range")
    vocabulary = scratch.keep(placed.select("lang", "term", (F.col("offset") + within).alias("ordinal")), "vocabulary")
    found = docs.mapInArrow(_tally(["lang", "source"], False), "lang string, source string, term string, n long")
    found = scratch.keep(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "found")
    groups = docs.select("lang", "source").distinct().select("lang", "source", F.lit(None).cast("long").alias("ordinal"), F.lit(0).cast("long").alias("n"))
    counted = found.join(vocabulary, ["lang", "term"]).select("lang", "source", "ordinal", "n")
    return vocabulary, scratch.keep(groups.union(counted), "counts")


def share(n: str | Column, total: str | Column, terms: str | Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)); 1 where a language has no terms."""
    n, total, terms = (F.col(c) if isinstance(c, str) else c for c in (n, total, terms))
    top = (n + 2).cast("decimal(28,0)") * F.lit(BILLION).cast("decimal(10,0)")
    return F.coalesce(F.call_function("div", top, F.nullif(total + 2 * terms, F.lit(0)).cast("decimal(28,0)")), F.lit(0)) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q are at most 10^9 + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(block: int):
    def run(rows: pa.Table) -> pa.Table:
        lang, low, high, part = (rows.column(c)[0].as_py() for c in ("lang", "low", "high", "part"))
        names = rows.column("source").combine_chunks().dictionary_encode()
        code = names.indices.to_numpy()
        ordinal = rows.column("ordinal").to_numpy()
        p = rows.column("p").to_numpy()
        head = ordinal < 0
        width = int(rows.column("width")[0].as_py())
        side = np.zeros(len(names.dictionary), dtype=np.int64)
        side[code] = rows.column("block").to_numpy()
        # every source has a head row with the share of a term that it lacks
        table = np.ones((len(names.dictionary), width), dtype=np.uint64)
        table[code[head]] = p[head].astype(np.uint64)[:, None]
        table[code[~head], ordinal[~head] - part * block] = p[~head]
        a, b = np.flatnonzero(side == low), np.flatnonzero(side == high)
        left, right, value = [], [], []
        for i in a:
            others = b[b > i] if low == high else b
            if not len(others):
                continue
            own, other = table[i], table[others]
            far = np.maximum(own, other) - np.minimum(own, other)
            value.append((far * far // (own + other)).sum(axis=1).astype(np.int64))
            left.append(np.full(len(others), i))
            right.append(others)
        i, j, v = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (left, right, value))
        return pa.table(
            {
                "lang": pa.array([lang] * len(i), pa.string()),
                "source": names.dictionary.take(pa.array(i, pa.int64())),
                "item": names.dictionary.take(pa.array(j, pa.int64())),
                "value": pa.array(v, pa.int64()),
            }
        )

    return run


def pair_values(scratch: Scratch, shares: DataFrame, groups: DataFrame, block: int, terms: int) -> DataFrame:
    """`lang, source, item, value` of every two sources of a language, both ways round.

    `shares` has `lang, source, place, p` of the terms a source has, where `place` counts
    the language's terms from 0; `groups` has `lang, source, none, terms`: the share of a
    term that it lacks, and the number of the language's terms.
    """
    blocks = scratch.keep(groups.groupBy("lang").agg(F.ceil(F.count("*") / block).alias("blocks")), "blocks")
    parts = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("terms") / terms) - 1))
    heads = groups.select("lang", "source", F.explode(parts).alias("part"), F.lit(-1).cast("long").alias("ordinal"), F.col("none").alias("p"), "terms")
    cells = shares.select("lang", "source", F.floor(F.col("place") / terms).alias("part"), F.col("place").alias("ordinal"), "p", "terms")
    width = F.least(F.lit(terms).cast("long"), F.col("terms") - F.col("part") * terms)
    rows = heads.union(cells).withColumn("width", width).join(blocks, "lang")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("source"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    tiles = rows.select("lang", "source", "part", "ordinal", "p", "width", "block", other)
    tiles = tiles.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other")
    found = tiles.groupBy("lang", "low", "high", "part").applyInArrow(
        _pairs(terms), "lang string, source string, item string, value long"
    )
    one = scratch.keep(found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pairs")
    return one.union(one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def audit_sources(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    max_key_bytes: int = MAX_KEY_BYTES,
    block_sources: int = BLOCK_SOURCES,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """`lang, source, part, item, value, rank`: every other source by its distance, and the terms most over-used."""
    need_text(docs, text, lang, source)
    scratch = Scratch(docs.sparkSession, "audit")
    docs = docs.select(_blank(lang).alias("lang"), _blank(source).alias("source"), _blank(text).alias("text"))
    kept = scratch.keep(kept_terms(docs, min_docs), "kept")
    vocabulary, counts = count_kept(scratch, docs, kept, max_key_bytes)

    # one row per language
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.min("ordinal").alias("first"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("lang_total")).join(sizes, "lang", "left")
    langs = scratch.keep(totals.fillna(0, ["terms", "first"]), "langs")
    # one row per group
    per_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang")
    groups = scratch.keep(per_group.withColumn("none", share(F.lit(0).cast("long"), "total", "terms")), "groups")
    # one row per group and kept term that it has
    cells = counts.where(F.col("ordinal").isNotNull()).join(groups, ["lang", "source"])
    cells = cells.select(
        "lang", "source", "ordinal", "n", "terms", "lang_total", (F.col("ordinal") - F.col("first")).alias("place"), share("n", "total", "terms").alias("p")
    )
    cells = scratch.keep(cells, "cells")

    pairs = pair_values(scratch, cells, groups.select("lang", "source", "none", "terms"), block_sources, block_terms)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))

    whole = scratch.keep(cells.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n")), "whole")
    against = cells.join(whole, ["lang", "ordinal"]).withColumn("q", share("lang_n", "lang_total", "terms"))
    over = against.where("p > q").select("lang", "source", "ordinal", gap(F.col("p"), F.col("q")).alias("value"))
    # ordinals are in the order of the terms
    by_gap = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = over.withColumn("rank", F.row_number().over(by_gap)).where(F.col("rank") <= top)
    named = best.join(vocabulary, ["lang", "ordinal"])
    return pairs.union(named.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))
