"""License scans by patience alignment.

A text and a license template are aligned on their words: common beginnings and
ends first, then words that occur once in both, of which the longest increasing
subsequence are anchors, and in the same way the gaps between anchors. Coverage
is the part of the template's words that are aligned; a template is found from
MIN_COVERAGE on.

A notice that stands in a text twice has no unique words there. So where the
whole text does not reach the coverage, windows are aligned too, and the best
counts. An alignment that reaches it lacks so many template words at most; of
that many and one more, the rarest in the text, it holds one, so windows of
several widths are laid around every occurrence of each of them. Windows of a
long template that lie within 1/64 of its length are aligned as one at first;
where that finds nothing, all of them are tried before a template is left out.

A template is tried only where enough of its words occur at all, and windows only
where the longest common subsequence is long enough. Both bound the coverage from
above, so nothing is lost by it.

Defined results: a NULL text counts as empty; a text without a template has an
empty list and a NULL license. Of equal coverages the longer template wins, then
the smaller name. An empty table gives an empty result. Repeated rows get equal
results; other columns are carried along, and where one is called `licenses`, the
result is called `licenses_`.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from itertools import product
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.llm.tables import free_name, need_text, text_slices

MIN_COVERAGE = 0.8
WORDS = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

# fixed values: notices by which texts name their license
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}


def known_licenses() -> dict[str, list[str]]:
    """The notices, and the bodies and headers in the folder `licenses`, by license; read by the driver only."""
    out = {name: [notice] for name, notice in NOTICES.items()}
    for path in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        name = path.name.removesuffix(".txt").removesuffix(".header").removesuffix(".grant").removesuffix(".regents")
        out.setdefault(name, []).append(path.read_text(encoding="utf-8"))
    return out


def license_words(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    below: list[int] = []
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        below.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[pile], piles[pile] = value, i
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = below[at]
    return out[::-1]


def _once(words: list[str], lo: int, hi: int, among: set[str] | None = None) -> dict[str, int]:
    """Positions of the words that occur once in a range."""
    place: dict[str, int] = {}
    for i in range(lo, hi):
        word = words[i]
        if among is None or word in among:
            place[word] = -1 if word in place else i
    return {w: i for w, i in place.items() if i >= 0}


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned positions (in text, in template), rising in both."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        theirs = _once(template, c, d)
        ours = _once(text, a, b, set(theirs))
        common = sorted((theirs[w], i) for w, i in ours.items())
        anchors = [common[k] for k in longest_increasing([i for _, i in common])]
        if not anchors:
            continue
        pairs += [(i, j) for j, i in anchors]
        ends = [(c - 1, a - 1), *anchors, (d, b)]
        gaps += [(i + 1, i2, j + 1, j2) for (j, i), (j2, i2) in zip(ends, ends[1:])]
    return sorted(pairs)


def common_length(text: list[str], template: list[str]) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    masks: dict[str, int] = {}
    for j, word in enumerate(template):
        masks[word] = masks.get(word, 0) | 1 << j
    full = (1 << len(template)) - 1
    row = full
    for word in text:
        if word in masks:
            hit = row & masks[word]
            row = ((row + hit) | (row - hit)) & full
    return len(template) - row.bit_count()


def scan(text: list[str], template: list[str], least: float) -> tuple[float, int, int] | None:
    """Coverage, first and last aligned word of the best alignment that reaches `least`."""
    need, n = Counter(template), len(template)
    in_text = Counter(w for w in text if w in need)
    if sum(min(m, in_text[w]) for w, m in need.items()) < least * n:
        return None

    def judged(lo: int, hi: int) -> tuple[float, int, int]:
        pairs = align(text[lo:hi], template)
        return (len(pairs) / n, lo + pairs[0][0], lo + pairs[-1][0]) if pairs else (0.0, lo, lo)

    best = judged(0, len(text))
    if best[0] >= least:
        return best
    top = common_length(text, template) / n
    if top < least:
        return None
    enough = next(m for m in range(n + 1) if m / n >= least)
    rarest = sorted(range(n), key=lambda j: (in_text[template[j]], j))[: n - enough + 1]
    places: dict[str, list[int]] = {}
    known = [0]
    for i, word in enumerate(text):
        known.append(known[-1] + (word in need))
        if word in need:
            places.setdefault(word, []).append(i)
    offsets = Counter(i - j for j in rarest for i in places.get(template[j], ()))
    fine = sorted({0, 1, 2, n // 16, n // 8, n // 4, n // 2, n})
    every = sorted(product(fine, fine), key=sum)
    seen: set[tuple[int, int]] = set()

    def windows(step: int, widths) -> Iterator[tuple[int, int]]:
        starts: Counter[int] = Counter()
        for offset, agree in offsets.items():
            starts[offset // step * step] += agree
        # places that most of the words agree on come first
        for start, _ in starts.most_common():
            for before, after in widths:
                window = max(0, start - before), min(len(text), start + step - 1 + n + after)
                if window not in seen and known[window[1]] - known[window[0]] >= enough:
                    seen.add(window)
                    yield window

    near = [(w, w) for w in (0, n // 16, n // 4, n)]
    # no window covers more than the longest subsequence
    for window in windows(n // 64, near) if n >= 64 else windows(1, every):
        best = max(best, judged(*window), key=lambda x: x[0])
        if best[0] >= top:
            return best
    if best[0] >= least:
        return best
    if n >= 64:
        # windows with the same words of the template align alike but for their ends; the bound goes by blocks of starts
        hopeful: dict[tuple[int, int], bool] = {}
        for lo, hi in windows(1, every):
            block = lo // (n // 8) * (n // 8), min(len(text), -(-hi // (n // 8)) * (n // 8))
            if block not in hopeful:
                hopeful[block] = common_length(text[block[0] : block[1]], template) >= enough
            if hopeful[block]:
                found = judged(lo, hi)
                if found[0] >= least:
                    return found
    return None


def scan_all(text: str | None, templates: list[tuple[str, list[str], Counter]], least: float) -> list[dict]:
    """The licenses found; `templates` has name, words and how often each occurs, a license one row per variant."""
    words = license_words(text)
    found: dict[str, tuple[tuple[float, int, int], int]] = {}
    known = set(words)
    for name, template, need in templates:
        size = len(template)
        # every word counts at most as often as it occurs, so a rough bound needs no counting
        if template and len(words) >= least * size and sum(m for w, m in need.items() if w in known) >= least * size:
            hit = scan(words, template, least)
            if hit and (name not in found or (hit[0], size) > (found[name][0][0], found[name][1])):
                found[name] = hit, size
    best = sorted(found.items(), key=lambda f: (-f[1][0][0], -f[1][1], f[0]))
    return [{"license": name, "coverage": c, "first_word": a, "last_word": b} for name, ((c, a, b), _) in best]


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str | Sequence[str]] = NOTICES,
    text: str = "text",
    least: float = MIN_COVERAGE,
) -> DataFrame:
    """Adds `licenses`, an array of (license, coverage, first_word, last_word) with the best first.

    A template may have several variants, of which the best counts.
    """
    need_text(docs, text)
    variants = [(name, license_words(v)) for name, body in templates.items() for v in ([body] if isinstance(body, str) else body)]
    cut = [(name, words, Counter(words)) for name, words in variants]

    @F.arrow_udf("array<struct<license: string, coverage: double, first_word: bigint, last_word: bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        item = pa.struct(
            [("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
        )
        for texts in text_slices(batches):
            yield pa.array([scan_all(t, cut, least) for t in texts], pa.list_(item))

    return docs.withColumn(free_name(docs, "licenses"), run(text))
