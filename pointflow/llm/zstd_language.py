"""Language ID by compression.

Each language has a zstandard raw-content dictionary, cut from a bounded sample
of its labelled texts. A text is compressed whole with every dictionary, and
the language whose dictionary makes it smallest is its language. The margin,
1 - smallest / second smallest, is the score; below MIN_MARGIN the answer is
marked as not accepted.

Case and everything but letters say little about a language, so texts are
lowered and every run of other characters becomes one blank, in training and
prediction alike.

Defined results: a text that is NULL or has no letters gets `und` with score 0
and is not accepted. Equal sizes go to the language with more labelled texts,
then the smaller name. With one learned language every text with letters gets it
with score 1; with none learned, all get `und`. An empty table gives an empty
result. Repeated rows get equal results; other columns are carried along, and
where one is called `language`, the result is called `language_`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointflow.llm.tables import free_name, need_text, text_slices

UNKNOWN = "und"
MIN_MARGIN = 0.01
# the sample of a language: so many texts, and so many characters of each
SAMPLE_TEXTS = 128
SAMPLE_CHARS = 1024
# dictionaries go to every task; more languages are refused
MAX_LANGUAGES = 512
LEVEL = 6
NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters_of(text: str) -> bytes:
    return NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


class LanguageModel:
    """One dictionary per language, the languages with most labelled texts first."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.dictionaries = dictionaries

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for content in self.dictionaries.values():
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False))
        return out

    def columns(self, docs: DataFrame, text: str | Column) -> Column:
        """`lang`, `score` and `accepted` of a text."""
        shared = docs.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("struct<lang: string, score: double, accepted: boolean>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            names, tools = list(shared.value.dictionaries), shared.value.compressors()
            for texts in text_slices(batches):
                found = [predict(t, names, tools) for t in texts]
                score = np.array([f[1] for f in found], dtype=float)
                lang = pa.array([f[0] for f in found], pa.string())
                accepted = pa.array(score >= MIN_MARGIN)
                yield pa.StructArray.from_arrays([lang, pa.array(score), accepted], names=["lang", "score", "accepted"])

        return run(text)


def predict(text: str | None, names: list[str], tools: list[zstandard.ZstdCompressor]) -> tuple[str, float]:
    if not names or not has_letter(text):
        return UNKNOWN, 0.0
    data = letters_of(text)
    sizes = [len(tool.compress(data)) for tool in tools]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    others = sizes[:best] + sizes[best + 1 :]
    return names[best], 1.0 - sizes[best] / min(others) if others else 1.0


def fit_languages(labelled: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Cut the dictionaries from at most SAMPLE_TEXTS texts of each language.

    A hash of the id draws the texts, so the model does not depend on the order
    of rows. Languages are counted first, without reading texts, which tells
    what part of a language must be read to have enough.
    """
    need_text(labelled, ident, text, lang)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.xxhash64(F.lit(5), F.col(ident)).alias("draw"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return LanguageModel({})
    part = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4 * SAMPLE_TEXTS / n))])
    drawn = rows.where(F.pmod("draw", F.lit(1 << 40)) / (1 << 40) < part[F.col("lang")])
    # a piece from a place that the hash names, as beginnings are more alike than texts
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))
    piece = F.substring(F.col("text"), F.pmod("draw", room).cast("int") + 1, F.lit(SAMPLE_CHARS))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "piece"))
    pieces = drawn.select("lang", "draw", piece.alias("piece")).withColumn("rank", rank).where(F.col("rank") <= SAMPLE_TEXTS)
    taken: dict[str, list[bytes]] = {}
    for row in pieces.orderBy("lang", "rank").collect():
        taken.setdefault(row["lang"], []).append(letters_of(row["piece"]))
    order = sorted((k for k in taken if any(taken[k])), key=lambda k: (-counts[k], k))
    return LanguageModel({k: b" ".join(taken[k]) for k in order})


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Adds `language`, a struct of lang, score and accepted, to the columns of `docs`."""
    need_text(docs, text)
    return docs.withColumn(free_name(docs, "language"), model.columns(docs, F.col(text)))
