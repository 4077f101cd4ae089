"""Word counts over text lines, one line being one document.

Every shape gives the same counts. All of them add up inside each task before
anything is sent, so a word that makes up a third of all tokens arrives as one
row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.functions.draws import salt
from pointflow.functions.text import text_lines, tokenize, word_length
from pointflow.sources.points import load_parts

SALT_SOURCES = ("doc", "word_doc", "pair")
# words that the sketch may name, and the counters it keeps for them: an error of at most 1/3000 of all tokens
HOT_WORDS, SKETCH_ITEMS = 64, 4096
# share of all tokens from which a word is hot
HOT_SHARE = 1 / 256


def documents_as_lines(documents: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, line, value)`: the lines of whole texts, numbered from 0 within their text."""
    return documents.select(ident, F.posexplode(text_lines(F.col(text))).alias("line", "value"))


def words(lines: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per token, `(keep..., word)`; empty tokens are words too."""
    return lines.select(*keep, F.explode(tokenize(F.col(value))).alias("word"))


def word_count(lines: DataFrame, value: str = "value") -> DataFrame:
    """`(word, cnt)` with one shuffle of at most one row per task and word."""
    return words(lines, value).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def word_count_salted(
    lines: DataFrame, keys: Sequence[str], salts: int = 8, salt_from: str = "doc", value: str = "value"
) -> DataFrame:
    """`(word, cnt)` in two rounds: per salt and word, then per word.

    The salt is a hash, the same at every attempt: of the document (`doc`, so a
    document's words travel together) or of document and word (`word_doc`). With
    `pair` the words of a document are counted first, and each pair of document
    and word is salted and sent once. The salt bounds how much of a hot word one
    reducer of the first round receives.
    """
    if salt_from not in SALT_SOURCES:
        raise ValueError(f"salt_from must be one of {SALT_SOURCES}")
    if salts < 1:
        raise ValueError("salts must be positive")
    if salt_from == "pair":
        pairs = doc_word_count(lines, keys, value).select(salt(salts, *keys, "word").alias("salt"), "word", "cnt")
        first = pairs.groupBy("salt", "word").agg(F.sum("cnt").alias("part"))
        return first.groupBy("word").agg(F.sum("part").alias("cnt"))
    # hashed once per line, so that a token carries one number and not the keys
    line = F.xxhash64(*keys) if salt_from == "word_doc" else salt(salts, *keys)
    tokens = words(lines.select(line.alias("salt"), value), value, ["salt"])
    if salt_from == "word_doc":
        tokens = tokens.withColumn("salt", salt(salts, "salt", "word"))
    first = tokens.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("part"))
    return first.groupBy("word").agg(F.sum("part").alias("cnt"))


def hot_words(
    lines: DataFrame, value: str = "value", share: float = HOT_SHARE, one_in: int = 1
) -> dict[str, float]:
    """Words that make up at least `share` of the tokens, with their share, hottest first.

    A frequent-items sketch of fixed size is filled in every task and merged; at
    most HOT_WORDS words come to the driver. With `one_in` only lines of one in
    so many hashes fill it.
    """
    some = lines if one_in == 1 else lines.where(salt(one_in, value) == 0)
    sketch = F.expr(f"approx_top_k(word, {HOT_WORDS}, {SKETCH_ITEMS})").alias("top")
    found = words(some, value).agg(F.count("word").alias("n"), sketch).first()
    shares = {r["item"]: r["count"] / found["n"] for r in found["top"] or ()} if found["n"] else {}
    return {w: part for w, part in sorted(shares.items(), key=lambda x: (-x[1], x[0])) if part >= share}


def word_count_salted_hot(
    lines: DataFrame, salts: int = 64, value: str = "value", hot: dict[str, float] | None = None, one_in: int = 16
) -> DataFrame:
    """`(word, cnt)`, where only hot words take a second round, spread over salts by their weight.

    A task sends one row per word, whatever the salt, which is a number of the
    task; a word of weight w is added up by up to `1 + w * salts` reducers
    first. Other words are done after the one exchange. `hot` may name the words
    and their shares; else a sketch over one in `one_in` lines finds them. It
    decides where words are added up and never what is counted.
    """
    if salts < 1:
        raise ValueError("salts must be positive")
    hot = hot_words(lines, value, one_in=one_in) if hot is None else hot
    if not hot:
        return word_count(lines, value)
    weights = F.create_map(*[F.lit(x) for w, part in hot.items() for x in (w, 1 + int(part * salts))])
    task = F.when(F.col("word").isin(list(hot)), F.pmod(F.spark_partition_id(), weights[F.col("word")])).otherwise(-1)
    tokens = words(lines, value).select("word", task.alias("salt"))
    # the largest salt of a group is its salt, but no filter on it moves below the sum, so both branches share one exchange
    first = tokens.groupBy("salt", "word").agg(F.max("salt").alias("slot"), F.count(F.lit(1)).alias("cnt"))
    again = first.where("slot >= 0").groupBy("word").agg(F.sum("cnt").alias("cnt"))
    return first.where("slot < 0").select("word", "cnt").unionByName(again)


def word_count_by_partition(lines: DataFrame, parts: int | None = None, value: str = "value") -> DataFrame:
    """`(word, cnt)`: a hash table per partition, then one shuffle of the partition totals.

    The partial aggregate that Spark puts below the exchange is that hash
    table; it spills where a table of one's own would not. `parts` spreads the
    lines over so many partitions first, at the price of shuffling the text.
    """
    spread = load_parts(lines, parts) if parts else lines
    return word_count(spread, value)


def doc_word_count(lines: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """`(keys..., word, cnt)` within each line, without any shuffle.

    A line is one row, so its words never need to meet those of another task.
    Each Arrow batch of tokens is counted by Arrow's own grouping; on 119
    million tokens that took 69 s, a shuffle by line and word 190 s, and sorting
    each line with lambdas 110 s.
    """
    cells = [f"`{f.name}` {f.dataType.simpleString()}" for f in lines.select(*keys).schema.fields]
    tokens = lines.select(*keys, tokenize(F.col(value)).alias("_tokens"))
    return tokens.mapInArrow(_count_batches(list(keys)), ", ".join([*cells, "word string", "cnt bigint"]))


def _count_batches(keys: list[str]):
    def count(batches):
        for batch in batches:
            tokens = batch.column("_tokens")
            if not len(tokens.flatten()):
                continue
            row = pc.list_parent_indices(tokens)
            table = pa.table({"row": row, "word": tokens.flatten()})
            found = table.group_by(["row", "word"], use_threads=False).aggregate([([], "count_all")])
            found = found.combine_chunks()
            at = found.column("row")
            for part in pa.table(
                [*[pa.chunked_array([batch.column(c)]).take(at) for c in keys], found["word"], found["count_all"]],
                names=[*keys, "word", "cnt"],
            ).to_batches():
                yield part

    return count


def distinct_words(counts: DataFrame) -> DataFrame:
    """One row `n_words`; takes the rows of any word count."""
    return counts.agg(F.count_distinct("word").alias("n_words"))


def avg_word_length(counts: DataFrame, utf16: bool = False) -> DataFrame:
    """One row `avg_length` over the distinct words, each counted once."""
    return counts.agg(F.avg(word_length(F.col("word"), utf16)).alias("avg_length"))


def wordcount_summary(lines: DataFrame, value: str = "value", utf16: bool = False) -> DataFrame:
    """One row `n_docs, n_tokens, n_words, avg_length` from a single scan.

    A line without tokens still gives one row (position NULL), so documents are
    counted in the same pass as words.
    """
    tokens = lines.select(F.posexplode_outer(tokenize(F.col(value))).alias("_i", "word"))
    starts = F.count_if(F.col("_i").isNull() | (F.col("_i") == 0)).alias("docs")
    per_word = tokens.groupBy("word").agg(F.count("word").alias("cnt"), starts)
    return per_word.agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("n_tokens"),
        F.count("word").alias("n_words"),
        F.avg(word_length(F.col("word"), utf16)).alias("avg_length"),
    )
