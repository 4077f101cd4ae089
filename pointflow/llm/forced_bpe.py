"""BPE encoding with forced boundaries, and decoding.

Merges only ever form vocabulary tokens. So two neighbouring bytes that stand
side by side inside no token can never end up in one token: between them is a
certain cut. A pre-token falls at its certain cuts into fragments that are
encoded independently, all fragments of a batch at once, and their ids are
concatenated. Each task remembers the ids of the white-space separated chunks
it has met, up to a bound, so a frequent word is encoded once.

The tokenizer file is read on the driver (its size is checked) and its tables
are broadcast (3 MB); executors need no file.

Defined results: a NULL text counts as empty; an empty text has no ids and
decodes to the empty text. Literal special tokens in a text become their ids,
as in the tokenizers library. Empty lists decode to the empty text. Other
columns are carried along, and where one is called `bpe`, the result is called
`bpe_`. Characters that came with Unicode 16 or later may be cut and lowered otherwise than there.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.llm.tables import free_name, need_text, text_slices

WORD_END = "</w>"
# a larger vocabulary file is refused, as its tables go to every task
MAX_FILE_BYTES = 64 << 20
# bytes of ids and chunks that a task remembers, an entry counting as 128 more; longer chunks are not remembered
CACHE_BYTES = 32 << 20
CACHE_ENTRY = 128
CACHE_CHUNK = 64
# bytes of text that are encoded at a time
SLICE_BYTES = 1 << 20
NO_RANK = np.int64(1 << 40)
_SLOT = np.uint64(0x9E3779B97F4A7C15)

# fixed values: the pre-token pattern, without its white space, which no chunk has, and the normaliser's white space
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{L}\p{N}]+"
PRE_TOKEN_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zA-Z]+|[0-9]|[^a-zA-Z0-9]+"
# separators that Python takes for white space and the tokenizer does not
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPACES = re.compile("[\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# fixed values: combining marks and composing letters that came after Unicode 9, up to which the tokenizer's NFC goes;
# it neither reorders nor composes them
NEWER_MARKS = (
    "\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c"
    "\U00010d24-\U00010d27\U00010eab-\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50\U00010f82-\U00010f85"
    "\U00011070\U0001133b\U0001145e\U00011839-\U0001183a\U00011930\U00011935\U00011938\U0001193d-\U0001193e"
    "\U00011943\U000119e0\U00011a34\U00011a47\U00011a99\U00011d42\U00011d44-\U00011d45\U00011d97"
    "\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae"
    "\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef"
)
NEWER = re.compile(f"([{NEWER_MARKS}]+)")


def composed(text: str) -> str:
    """NFC as the tokenizer has it."""
    if not NEWER.search(text):
        return unicodedata.normalize("NFC", text)
    return "".join([x if NEWER.match(x) else unicodedata.normalize("NFC", x) for x in NEWER.split(text)])


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is printable, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def read_tables(path: str) -> dict:
    """What encoding and decoding need of a tokenizer file, as plain arrays and lists."""
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError("tokenizer file too large to send to every task")
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, vocab = spec["model"], spec["model"]["vocab"]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
        raise ValueError("not a BPE vocabulary with word ends")
    letters = byte_letters()
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*vocab.values(), *specials.values()]) + 1)
    for token, i in [*vocab.items(), *specials.items()]:
        tokens[i] = token

    # symbol s below 256 is a byte inside a word, 256 + s the last byte of a word
    start = np.array([vocab[c] for c in letters] + [vocab[c + WORD_END] for c in letters], dtype=np.int64)
    byte_of = {c: b for b, c in enumerate(letters)}
    inside = np.zeros((512, 512), dtype=bool)
    for token in vocab:
        body = token[: -len(WORD_END)] if token.endswith(WORD_END) else token
        symbols = [byte_of[c] for c in body]
        if token.endswith(WORD_END) and symbols:
            symbols[-1] += 256
        inside[symbols[:-1], symbols[1:]] = True

    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([vocab[a] * len(tokens) + vocab[b] for a, b in pairs], dtype=np.int64)
    merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
    return {"tokens": tokens, "specials": specials, "start": start, "inside": inside, "keys": keys, "merged": merged}


class Merges:
    """Rank and result of a pair of ids: an open hash table that is asked for many pairs at once."""

    def __init__(self, keys: np.ndarray, merged: np.ndarray, width: int):
        self.width = width
        self.bits = max(4, int(4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.ranks = np.full(size, NO_RANK)
        self.results = np.zeros(size, dtype=np.int64)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist())):
            while self.keys[slot] >= 0 and self.keys[slot] != key:
                slot = (slot + 1) % size
            if self.keys[slot] < 0:
                self.keys[slot], self.ranks[slot], self.results[slot] = key, rank, merged[rank]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SLOT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left * self.width + right
        slots = self._slots(keys)
        there = self.keys[slots]
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            there[open_] = self.keys[slots[open_]]
            open_ = open_[(there[open_] != keys[open_]) & (there[open_] >= 0)]
        return np.where(there == keys, self.ranks[slots], NO_RANK), self.results[slots]


class Encoder:
    def __init__(self, tables: dict):
        self.start, self.inside = tables["start"], tables["inside"]
        self.merges = Merges(tables["keys"], tables["merged"], len(tables["tokens"]))
        self.specials = tables["specials"]
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.pre_token = regex.compile(PRE_TOKEN)
        self.pre_token_ascii = re.compile(PRE_TOKEN_ASCII)
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    def fragments(self, symbols: np.ndarray) -> np.ndarray:
        """Number of the fragment of each symbol: words end, and certain cuts lie, between fragments."""
        cut = (symbols[:-1] >= 256) | ~self.inside[symbols[:-1], symbols[1:]]
        return np.concatenate([[0], np.cumsum(cut)])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the n + 1 offsets of the words in them. No word is empty."""
        data = [w.encode("utf-8", "replace") for w in words]
        ends = np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))
        symbols = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.int64)
        symbols[ends - 1] += 256
        out, alive = self.start[symbols], np.ones(len(symbols), dtype=bool)
        self._merge(out, alive, self.fragments(symbols))
        return out[alive], np.concatenate([[0], np.cumsum(alive)[ends - 1]])

    def _merge(self, out: np.ndarray, alive: np.ndarray, fragment: np.ndarray) -> None:
        """Merge each fragment's pair of lowest rank, left to right, until no pair of any has a rank."""
        at, ids = np.arange(len(out)), out.copy()
        while len(ids) > 1:
            rank, result = np.full(len(ids), NO_RANK), np.zeros(len(ids), dtype=np.int64)
            near = np.flatnonzero(fragment[:-1] == fragment[1:])
            rank[near], result[near] = self.merges.find(ids[near], ids[near + 1])
            first = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            low = np.minimum.reduceat(rank, first)
            lows = np.repeat(low, np.diff(np.append(first, len(ids))))
            hits = np.flatnonzero((rank == lows) & (rank < NO_RANK))
            if not len(hits):
                break
            # of overlapping pairs, as in "aaa", every second one counts from the left
            run = np.concatenate([[True], np.diff(hits) != 1])
            run_first = hits[run][np.cumsum(run) - 1]
            hits = hits[(hits - run_first) % 2 == 0]
            ids[hits] = result[hits]
            out[at[hits]] = ids[hits]
            alive[at[hits + 1]] = False
            stay = lows < NO_RANK
            stay[hits + 1] = False
            at, ids, fragment = at[stay], ids[stay], fragment[stay]

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        words, counts = [], []
        for chunk in chunks:
            found = (self.pre_token_ascii if chunk.isascii() else self.pre_token).findall(chunk)
            words += found
            counts.append(len(found))
        if not words:
            return dict.fromkeys(chunks, b"")
        ids, offsets = self.encode_words(words)
        packed = ids.astype("<u4").tobytes()
        bounds = (4 * offsets[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        return {chunk: packed[lo:hi] for chunk, lo, hi in zip(chunks, bounds, bounds[1:])}

    def _chunks(self, text: str) -> list[str]:
        """Normalised white-space separated chunks of a text without special tokens."""
        if not text.isascii():
            # the tokenizer lowers letter by letter, without the rule for a sigma at the end of a word
            text = composed(text).replace("Σ", "σ")
        text = text.lower()
        return [c for c in SPACES.split(text) if c] if NOT_SPACE.search(text) else text.split()

    def _parts(self, text: str | None) -> list:
        """Chunk lists and, between them, the packed ids of special tokens."""
        if not text:
            return []
        if self.special is None or not self.special.search(text):
            return [self._chunks(text)]
        parts, done = [], 0
        for found in self.special.finditer(text):
            parts.append(self._chunks(text[done : found.start()]))
            parts.append(self.specials[found.group()].to_bytes(4, "little"))
            done = found.end()
        return [*parts, self._chunks(text[done:])]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the n + 1 offsets of the texts in them."""
        packed = self._encode_slice(texts)
        lengths = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        return np.frombuffer(b"".join(packed), dtype="<u4"), np.concatenate([[0], np.cumsum(lengths)])

    def _encode_slice(self, texts: list[str | None]) -> list[bytes]:
        whole = [self._parts(t) for t in texts]
        seen: set[str] = set()
        for parts in whole:
            for part in parts:
                if isinstance(part, list):
                    seen.update(part)
        missing = [c for c in seen if c not in self.cache]
        fresh = self._learn(missing) if missing else {}
        self.cache.update(fresh)
        known = self.cache.__getitem__
        out = [
            b"".join([p if isinstance(p, bytes) else b"".join(map(known, p)) for p in parts]) for parts in whole
        ]
        # a slice adds little more than its own size, so the bound is kept between slices
        for chunk, ids in fresh.items():
            if len(chunk) > CACHE_CHUNK:
                del self.cache[chunk]
            else:
                self.cached += CACHE_ENTRY + 4 * len(chunk) + len(ids)
        if self.cached > CACHE_BYTES:
            self.cache.clear()
            self.cached = 0
        return out


def decode_ids(ids: np.ndarray, tokens: list[str]) -> str:
    """The tokens of the ids with single blanks between, as this vocabulary has no decoder of its own."""
    return " ".join(map(tokens.__getitem__, ids.tolist()))


# what a text can be turned into, and the type of each form
FORMS = {"ids": "array<int>", "packed": "binary", "decoded": "string"}


def _form(name: str, ids: np.ndarray, offsets: np.ndarray, tokens: list[str]) -> pa.Array:
    spans = list(zip(offsets.tolist(), offsets[1:].tolist()))
    if name == "ids":
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
    if name == "packed":
        return pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary())
    return pa.array([decode_ids(ids[a:b], tokens) for a, b in spans], pa.string())


def encode_documents(docs: DataFrame, path: str, text: str = "text", forms: Sequence[str] = ("ids",)) -> DataFrame:
    """Adds `bpe`, a struct with what is asked for of the whole text's tokens.

    `ids` as a list, `packed` as little-endian unsigned 32-bit integers, and
    `decoded`, the text that the ids stand for. All come from one pass, so that
    a task needs one Python worker.
    """
    need_text(docs, text)
    tables = docs.sparkSession.sparkContext.broadcast(read_tables(path))

    @F.arrow_udf(f"struct<{', '.join(f'{f}: {FORMS[f]}' for f in forms)}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, tokens = Encoder(tables.value), tables.value["tokens"]
        for texts in text_slices(batches, SLICE_BYTES):
            ids, offsets = encoder.encode(texts)
            yield pa.StructArray.from_arrays([_form(f, ids, offsets, tokens) for f in forms], names=list(forms))

    return docs.withColumn(free_name(docs, "bpe"), run(F.col(text)))


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the text that a list of ids stands for."""
    need_text(docs, ids)
    tables = docs.sparkSession.sparkContext.broadcast(read_tables(path))

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        tokens, values, offsets = tables.value["tokens"], column.values, column.offsets.to_pylist()
        spans = zip(offsets, offsets[1:])
        return pa.array([decode_ids(values[a:b].to_numpy(), tokens) for a, b in spans], pa.string())

    return docs.withColumn(decoded, run(F.col(ids)))
