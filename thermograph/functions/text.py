"""Tokenizer expressions: words are separated by single spaces or newlines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text: Column | str) -> Column:
    """ARRAY<STRING> of the words of a whole text.

    Every separator ends the current word, so runs of separators give empty
    words; one trailing separator gives nothing more; an empty text gives one
    empty word.  ``\\z`` (not ``$``) anchors at the very end.
    """
    body = F.regexp_replace(_col(text), r"[ \n]\z", "")
    return F.split(body, r"[ \n]", -1)


def letter_occurrences(text: Column | str, letter: str) -> Column:
    """How many times ``letter`` occurs in the text, without exploding it."""
    t = _col(text)
    return F.length(t) - F.length(F.replace(t, F.lit(letter), F.lit("")))
