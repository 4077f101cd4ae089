"""Tokens and word lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_lines(text: Column) -> Column:
    """The lines of a whole text; one line is one document for the word counts."""
    return F.split(text, "\n")


def tokenize(line: Column) -> Column:
    """Split at single spaces only.

    Leading and inner empty tokens stay, trailing ones go; the empty line has
    one empty token and a line of spaces has none. Case and punctuation stay.
    """
    body = F.rtrim(line)
    tokens = F.split(body, " ")
    return F.when((body == "") & (line != ""), F.slice(tokens, 1, 0)).otherwise(tokens)


def word_length(word: Column, utf16: bool = False) -> Column:
    """Length in code points, or in UTF-16 units on request."""
    if utf16:
        return (F.octet_length(F.encode(word, "UTF-16BE")) / 2).cast("int")
    return F.length(word)
