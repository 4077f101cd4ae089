from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from pointflow.functions.text import tokenize
from pointflow.operators import words

KEYS = ["doc_id", "line"]
TEXTS = [
    "a b  c  ",
    "",
    " ",
    "   ",
    " x",
    "the the the\tend\nthe\n\nlast \U0001f600 line",
    "the " * 500 + "end",
    "Case case case.",
]


@pytest.fixture(scope="module")
def lines(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    return words.documents_as_lines(docs.repartition(3))


def all_lines():
    return [(i, j, line) for i, text in enumerate(TEXTS) for j, line in enumerate(text.split("\n"))]


def total():
    return Counter(t for _, _, line in all_lines() for t in brute.tokens(line))


@pytest.mark.parametrize(
    "line, want",
    [("a b  c  ", ["a", "b", "", "c"]), ("", [""]), (" ", []), ("   ", []), (" x", ["", "x"]), ("a\tb ", ["a\tb"])],
)
def test_tokenize(spark, line, want):
    assert spark.range(1).select(tokenize(F.lit(line))).first()[0] == want
    assert brute.tokens(line) == want


def test_every_shape_counts_the_same(lines):
    for counts in (
        words.word_count(lines),
        words.word_count_salted(lines, KEYS, 3),
        words.word_count_salted(lines, KEYS, 3, "word_doc"),
        words.word_count_by_partition(lines),
        words.word_count_by_partition(lines, 4),
    ):
        assert {r["word"]: r["cnt"] for r in counts.collect()} == total()


def test_counts_within_documents(lines):
    got = {(r["doc_id"], r["line"], r["word"]): r["cnt"] for r in words.doc_word_count(lines, KEYS).collect()}
    want = {(i, j, w): c for i, j, line in all_lines() for w, c in Counter(brute.tokens(line)).items()}
    assert got == want


def test_summary(lines):
    counts, n = total(), len(all_lines())
    avg = sum(map(len, counts)) / len(counts)
    row = words.wordcount_summary(lines).first()
    assert tuple(row)[:3] == (n, sum(counts.values()), len(counts))
    assert row["avg_length"] == pytest.approx(avg)
    assert words.distinct_words(words.word_count(lines)).first()[0] == len(counts)
    assert words.distinct_words(words.words(lines)).first()[0] == len(counts)
    assert words.avg_word_length(words.word_count(lines)).first()[0] == pytest.approx(avg)
    utf16 = words.avg_word_length(words.word_count(lines), utf16=True).first()[0]
    assert utf16 == pytest.approx(avg + 1 / len(counts))
    assert tuple(words.wordcount_summary(lines.where("doc_id > 99")).first()) == (0, 0, 0, None)


def test_bad_arguments(lines):
    with pytest.raises(ValueError):
        words.word_count_salted(lines, KEYS, 0)
    with pytest.raises(ValueError):
        words.word_count_salted(lines, KEYS, 2, "other")
