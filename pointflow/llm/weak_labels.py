"""Quality classifier from weak labels.

Nine heuristic labellers vote good, bad or nothing on a text. Only how often
each pattern of votes occurs is counted (at most 3^9 patterns, over all
documents). On these counts expectation-maximisation estimates how often each
labeller votes bad on bad and on good texts, which gives every pattern a
posterior probability of being good. The posteriors of a sample, at most
SAMPLE_DOCS per side, then train a logistic scorer over hashed byte trigrams and
the votes themselves, which judges every whole text. Trigrams show what a text
is made of, votes what no trigram shows, such as words that repeat.

Defined results: a NULL text counts as empty; a text without words has score 0
and is rejected. If one of the two sides has no documents, no scorer can be
trained, and the posterior of a text's votes is its score. An empty table gives an
empty result. Repeated rows get equal results; other columns are carried along,
and where one of them is called `quality`, the result is called `quality_`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointflow.llm.tables import free_name, need_text, text_slices

BAD, GOOD, NONE = 0, 1, 2
# documents of each side that the scorer is trained on, a documented bound
SAMPLE_DOCS = 4096
TRIGRAM_BITS = 13
# trigrams of no weight that every text is taken to have, so that a few words decide little
PRIOR_TRIGRAMS = 100
# what a vote counts as, where all trigrams of a text together count as 1
VOTE_SHARE = 0.1
EM_ROUNDS = 100
TRAIN_ROUNDS = 150
KEEP_FROM = 0.5
WINDOW_WORDS = 100

_SYMBOLS = b"#$%&*+<=>@[\\]^_`{|}~"
_kinds = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "symbol": _SYMBOLS,
    "bang": b"!",
    "stop": b".?!",
    "space": (9, 10, 11, 12, 13, 32),
}
SYMBOL_WORD = re.compile(rb"[" + re.escape(_SYMBOLS) + rb"][^ \t-\r]*")
KINDS = {name: np.isin(np.arange(256), list(codes)) for name, codes in _kinds.items()}
KIND_TABLE = np.stack(list(KINDS.values()), axis=1).astype(np.int64)
# labellers: a share of something, and the shares from which and up to which it votes
LABELLERS = {
    "shouting": ("upper_share", 0.30, 0.15),
    "symbols": ("symbol_share", 0.03, 0.01),
    "bangs": ("bang_share", 0.20, 0.05),
    "symbol words": ("symbol_words", 0.25, 0.05),
    "stutter": ("repeat_share", 0.20, 0.05),
    "monotony": ("same_share", 0.70, 0.55),
    "boilerplate": ("line_share", 0.50, 0.20),
    "sentences": ("run_on", 80.0, 40.0),
    "long words": ("word_bytes", 25.0, 14.0),
}
PATTERNS = 3 ** len(LABELLERS)
WEIGHTS = (1 << TRIGRAM_BITS) + 2 * len(LABELLERS)


def joined_bytes(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The texts as bytes, all of them in one array, and the n + 1 offsets."""
    data = [t.encode("utf-8", "replace") if t else b"" for t in texts]
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))])
    return data, np.frombuffer(b"".join(data), dtype=np.uint8), offsets


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _word_shares(text: bytes) -> tuple[int, float, float]:
    """Words, the share that repeat the word before them, and the share that are not new in their window."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0, 0.0, 0.0
    fresh = sum(len(set(words[i : i + WINDOW_WORDS])) for i in range(0, n, WINDOW_WORDS))
    return n, sum(map(eq, words, words[1:])) / n, 1 - fresh / n


def _symbol_words(text: bytes) -> int:
    """Words with a symbol in them."""
    return len(SYMBOL_WORD.findall(text))


def _line_share(text: bytes) -> float:
    lines = [x for x in text.split(b"\n") if x]
    return 1 - len(set(lines)) / len(lines) if lines else 0.0


def measures(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The shares that the labellers look at, and `words`."""
    data = [t.encode("utf-8", "replace") if t else b"" for t in texts]
    counts = np.array([np.bincount(np.frombuffer(x, np.uint8), minlength=256) @ KIND_TABLE for x in data])
    count = dict(zip(KINDS, counts.reshape(-1, len(KINDS)).T))
    words, repeats, same = (np.array(x) for x in zip(*map(_word_shares, data))) if data else (np.zeros(0),) * 3
    visible = np.maximum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)) - count["space"], 1)
    return {
        "words": words,
        "upper_share": count["upper"] / np.maximum(count["upper"] + count["lower"], 80),
        "symbol_share": count["symbol"] / visible,
        "bang_share": count["bang"] / np.maximum(words, 1),
        "symbol_words": np.array([_symbol_words(x) for x in data]) / np.maximum(words, 1),
        "repeat_share": repeats,
        "same_share": same,
        "line_share": np.array([_line_share(x) for x in data]),
        "run_on": words / (count["stop"] + 1),
        "word_bytes": visible / np.maximum(words, 1),
    }


def vote_patterns(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Votes of all labellers as one number to base 3, and the words of each text.

    Texts of fewer than 20 words say too little: there a labeller may vote bad but not good.
    """
    shares = measures(texts)
    pattern = np.zeros(len(texts), dtype=np.int64)
    for share, bad_from, good_to in LABELLERS.values():
        value = shares[share]
        vote = np.where(value >= bad_from, BAD, np.where((value <= good_to) & (shares["words"] >= 20), GOOD, NONE))
        pattern = pattern * 3 + vote
    return pattern, shares["words"]


def votes_of(patterns: np.ndarray) -> np.ndarray:
    """(patterns, labellers) votes."""
    power = 3 ** np.arange(len(LABELLERS))[::-1]
    return np.asarray(patterns)[:, None] // power % 3


def fit_accuracies(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior probability of good per pattern, and each labeller's chance of a bad vote on bad and on good texts.

    A missing vote says nothing. The start takes a text with any bad vote for
    bad; pseudo-counts keep all chances off 0 and 1.
    """
    votes, counts = votes_of(patterns), np.asarray(counts, dtype=float)
    bad, good = votes == BAD, votes == GOOD
    posterior = np.where(bad.any(axis=1), 0.1, 0.9)
    for _ in range(EM_ROUNDS):
        weight_bad, weight_good = counts * (1 - posterior), counts * posterior
        on_bad = (weight_bad @ bad + 0.5) / (weight_bad @ (bad | good) + 2)
        on_good = (weight_good @ bad + 0.01) / (weight_good @ (bad | good) + 2)
        # a labeller never counts against what it says
        on_bad = np.maximum(on_bad, on_good)
        prior = (weight_good.sum() + 1) / (counts.sum() + 2)
        score = np.log(prior / (1 - prior)) + bad @ np.log(on_good / on_bad) + good @ np.log((1 - on_good) / (1 - on_bad))
        following = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        settled = np.abs(following - posterior).max(initial=0) < 1e-9
        posterior = following
        if settled:
            break
    return posterior, on_bad, on_good


def trigram_slots(codes: np.ndarray) -> np.ndarray:
    """The hash slot of the three bytes from each position on."""
    wide = codes.astype(np.uint32)
    value = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    return (value * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAM_BITS)


def _inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which of n trigram positions lie within one text."""
    within = np.ones(n + 2, dtype=bool)
    for back in (1, 2):
        ends = offsets[1:] - back
        within[ends[ends >= 0]] = False
    return within[:n]


def vote_marks(patterns: np.ndarray) -> np.ndarray:
    """(texts, 2 x labellers) marks of the votes that were cast: bad ones first, then good ones."""
    votes = votes_of(patterns)
    return np.concatenate([votes == BAD, votes == GOOD], axis=1)


def score_texts(texts: list[str | None], patterns: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of good: a logistic function of the weights of trigrams, over their number, and of votes."""
    trigrams, cast = weights[: 1 << TRIGRAM_BITS], weights[1 << TRIGRAM_BITS :]
    _, codes, offsets = joined_bytes(texts)
    value = np.zeros(len(codes))
    if len(codes) > 2:
        inside = _inside(offsets, len(codes) - 2)
        value[:-2] = np.where(inside, trigrams[trigram_slots(codes)], 0.0)
    number = np.maximum(np.diff(offsets) - 2, 0) + PRIOR_TRIGRAMS
    total = _per_text(value, offsets) / number + VOTE_SHARE * (vote_marks(patterns) @ cast) + bias
    return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _features(text: str | None, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots of a text's trigrams and votes, and the share of each."""
    codes = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    slots, counts = np.unique(trigram_slots(codes) if len(codes) > 2 else np.zeros(0, np.uint32), return_counts=True)
    cast = np.flatnonzero(marks) + (1 << TRIGRAM_BITS)
    shares = counts / (max(0, len(codes) - 2) + PRIOR_TRIGRAMS)
    return np.append(slots, cast).astype(np.int32), np.append(shares, np.full(len(cast), VOTE_SHARE))


def train_scorer(row: np.ndarray, slot: np.ndarray, value: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, by Adam steps over all rows.

    Row `row[i]` has the share `value[i]` in `slot[i]`.
    """
    width, rows = WEIGHTS, len(target)
    theta, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, TRAIN_ROUNDS + 1):
        logit = np.bincount(row, value * theta[slot], minlength=rows) + theta[-1]
        error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - target) / rows
        gradient = np.append(np.bincount(slot, value * error[row], minlength=width), error.sum())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta -= 0.5 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _pattern_column(text: str | Column) -> Column:
    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            yield pa.array(vote_patterns(texts)[0])

    return run(text)


class QualityModel:
    """Posteriors by vote pattern and the scorer that they trained, if any; small enough to travel with each task."""

    def __init__(self, posterior: dict[int, float], on_bad, on_good, weights: np.ndarray | None, bias: float):
        self.posterior, self.on_bad, self.on_good = posterior, on_bad, on_good
        self.weights, self.bias = weights, bias

    def columns(self, text: str | Column) -> Column:
        """`score`, `posterior` and `kept` of a text."""
        table = np.full(PATTERNS, 0.5)
        for pattern, value in self.posterior.items():
            table[pattern] = value
        weights, bias = self.weights, self.bias

        @F.arrow_udf("struct<score: double, posterior: double, kept: boolean>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in text_slices(batches):
                pattern, words = vote_patterns(texts)
                score = table[pattern] if weights is None else score_texts(texts, pattern, weights, bias)
                score = np.where(words > 0, score, 0.0)
                yield pa.StructArray.from_arrays(
                    [pa.array(score), pa.array(table[pattern]), pa.array(score >= KEEP_FROM)],
                    names=["score", "posterior", "kept"],
                )

        return run(text)


def _features_column(text: str | Column, patterns: list[int]) -> Column:
    """Vote pattern, slots and shares of a text whose pattern is one of those given, else NULL."""
    wanted = np.zeros(PATTERNS, dtype=bool)
    wanted[patterns] = True

    @F.arrow_udf("struct<pattern: bigint, slots: array<int>, shares: array<double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            pattern, _ = vote_patterns(texts)
            there = wanted[pattern]
            marks = vote_marks(pattern)
            pairs = [_features(t, m) if w else ((), ()) for t, m, w in zip(texts, marks, there)]
            slots = pa.array([p[0] for p in pairs], pa.list_(pa.int32()))
            shares = pa.array([p[1] for p in pairs], pa.list_(pa.float64()))
            names = ["pattern", "slots", "shares"]
            yield pa.StructArray.from_arrays([pa.array(pattern), slots, shares], names=names, mask=pa.array(~there))

    return run(text)


def _trainer(posterior: dict[int, float]):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        slots, shares = rows.column("slots").chunk(0), rows.column("shares").chunk(0)
        target = np.array([posterior[p] for p in rows.column("pattern").to_pylist()])
        row = np.repeat(np.arange(len(target)), np.diff(slots.offsets.to_numpy()))
        weights, bias = train_scorer(row, slots.flatten().to_numpy(), shares.flatten().to_numpy(), target)
        return pa.table({"weights": pa.array([weights.tolist()], pa.list_(pa.float64())), "bias": pa.array([bias])})

    return run


def fit_quality(docs: DataFrame, ident: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> QualityModel:
    """Fit the label model on the vote patterns of all documents, and the scorer on a sample of both sides."""
    need_text(docs, ident, text)
    rows = docs.select(F.xxhash64(F.lit(11), F.col(ident)).alias("draw"), F.col(text).alias("text"))
    # at most PATTERNS rows come back
    tally = rows.select(_pattern_column("text").alias("pattern")).groupBy("pattern").count().collect()
    patterns, counts = np.array([r[0] for r in tally], dtype=np.int64), np.array([r[1] for r in tally])
    posterior, on_bad, on_good = fit_accuracies(patterns, counts)
    by_pattern = dict(zip(patterns.tolist(), posterior.tolist()))
    sides = {side: int(counts[(posterior >= 0.5) == side].sum()) for side in (False, True)}
    if not all(sides.values()):
        return QualityModel(by_pattern, on_bad, on_good, None, 0.0)

    # a hash of the id draws somewhat more than the sample, whose exact size a top-k by that hash sets
    unit = F.pmod("draw", F.lit(1 << 40)) / (1 << 40)
    part = {side: min(1.0, 1.2 * sample / n) for side, n in sides.items()}
    sides_of = {side: [p for p, v in by_pattern.items() if (v >= 0.5) == side] for side in (True, False)}

    # features are bounded, texts are not: so features come first, and the top-k holds no text
    picked = [
        rows.where(unit < part[side])
        .select("draw", _features_column("text", patterns).alias("f"))
        .where("f IS NOT NULL")
        .orderBy("draw", "f.pattern", "f.slots")
        .limit(sample)
        for side, patterns in sides_of.items()
    ]
    rows = picked[0].union(picked[1]).select(F.lit(0).alias("all"), "f.pattern", "f.slots", "f.shares")
    row = rows.groupBy("all").applyInArrow(_trainer(by_pattern), "weights array<double>, bias double").first()
    # both sides weigh alike in the sample; the bias brings their true shares back
    odds = np.log(sides[True] / sides[False]) - np.log(min(sides[True], sample) / min(sides[False], sample))
    return QualityModel(by_pattern, on_bad, on_good, np.array(row["weights"]), row["bias"] + float(odds))


def judge_quality(docs: DataFrame, ident: str = "doc_id", text: str = "text", model: QualityModel | None = None) -> DataFrame:
    """Adds `quality` (`quality_` if that is taken), a struct of score, posterior and kept, to the columns of `docs`."""
    need_text(docs, ident, text)
    model = model or fit_quality(docs, ident, text)
    return docs.withColumn(free_name(docs, "quality"), model.columns(F.col(text)))


def keep_quality(docs: DataFrame, ident: str = "doc_id", text: str = "text", model: QualityModel | None = None) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    need_text(docs, ident, text)
    model = model or fit_quality(docs, ident, text)
    return docs.where(model.columns(F.col(text)).getField("kept"))
