"""Word shingles of whole texts as 64-bit sets, and MinHash signatures of such sets.

Words are maximal runs without ASCII white space, A-Z in lower case. A text of
fewer words than a shingle is one shingle as a whole; a text without words has
none. `bytes.lower` and `bytes.split` have exactly these meanings.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np

HASHES = 128
BAND_ROWS = 4
BANDS = HASHES // BAND_ROWS
# shingles that are hashed at a time, so that a block stays in cache
BLOCK_SHINGLES = 1 << 15
# bytes of words that are hashed at a time, but for a longer word
BLOCK_BYTES = 1 << 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_draws = np.random.default_rng(20240229).integers(0, 1 << 63, size=(2, HASHES), dtype=np.uint64)
_FACTOR, _SHIFT = (_draws[0] << np.uint64(1)) | np.uint64(1), _draws[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the SplitMix64 finisher)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word: its bytes, mixed with their places, added up."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    out = sizes.astype(np.uint64) * _ODD
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    at = 0
    while at < len(words):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK_BYTES)))
        low, high = starts[at], starts[end - 1] + sizes[end - 1]
        place = np.arange(low, high) - np.repeat(starts[at:end], sizes[at:end])
        cells = mix((place.astype(np.uint64) << np.uint64(8) | data[low:high]) * _ODD)
        filled = at + np.flatnonzero(sizes[at:end])
        out[filled] += np.add.reduceat(cells, starts[filled] - low) if len(filled) else cells
        at = end
    return mix(out)


def _sequence_hash(h: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    value = np.full(len(starts), length, dtype=np.uint64) * _ODD
    for j in range(length):
        value = mix(value * _ODD + h[starts + j])
    return value


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All distinct shingles, sorted within each text, and the n + 1 offsets of the texts in them."""
    words = [words_of(t) for t in texts]
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    h = hash_words(list(chain.from_iterable(words)))
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    counts = np.where(n >= width, n - width + 1, 0)
    long_docs = np.repeat(np.arange(len(n)), counts)
    within = np.arange(len(long_docs)) - np.repeat(np.cumsum(counts) - counts, counts)
    docs, values = [long_docs], [_sequence_hash(h, first[long_docs] + within, width)]
    for length in range(1, width):
        short = np.flatnonzero(n == length)
        docs.append(short)
        values.append(_sequence_hash(h, first[short], length))
    doc, value = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[fresh], value[fresh]
    return value, np.searchsorted(doc, np.arange(len(n) + 1))


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(n, HASHES) 16-bit marks; two sets agree in a mark with the probability of their similarity.

    A mark is a hash of the least permuted shingle, so sets without a common
    shingle agree only by the chance of 2^-16. Empty sets get zeros.
    """
    out = np.zeros((len(offsets) - 1, HASHES), dtype=np.uint16)
    used = np.flatnonzero(np.diff(offsets))
    at = 0
    while at < len(used):
        end = max(at + 1, np.searchsorted(offsets[used], offsets[used[at]] + BLOCK_SHINGLES))
        block = used[at:end]
        lo, hi = offsets[block[0]], offsets[block[-1] + 1]
        part, starts = values[lo:hi], offsets[block] - lo
        for j in range(HASHES):
            low = np.minimum.reduceat(part * _FACTOR[j] + _SHIFT[j], starts)
            out[block, j] = (mix(low) >> np.uint64(48)).astype(np.uint16)
        at = end
    return out


def set_key(shingles: np.ndarray) -> bytes:
    """A 128-bit name of a set, equal only for equal sets."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
