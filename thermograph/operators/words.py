"""Word and letter counts over whole texts.

A text is one or more rows that share a ``doc`` (a file, a document, or the
lines of a file too large for one row): rows that repeat ``doc`` are one text,
in every count here.  Counting is a shuffle aggregation whose map side
pre-aggregates, so a very frequent word sends one partial count per task, not
one row per occurrence, and a text of many rows is spread over tasks by its
words.  A null text has no words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.constants import LETTERS
from thermograph.functions.text import letter_occurrences, split_words


def tokens(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, word): one row per word occurrence of each whole text."""
    return docs.select(doc, F.explode(split_words(text)).alias("word"))


def word_count_per_doc(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, word, n): occurrences of each word in the texts of each ``doc``."""
    return tokens(docs, doc, text).groupBy(doc, "word").agg(F.count(F.lit(1)).alias("n"))


def word_count(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): occurrences of each word over all texts."""
    return tokens(docs, doc, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def distinct_words_per_doc(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_words): distinct words of each ``doc``.

    Words are made distinct inside the row, then by (doc, word), which spreads
    a text of many rows over tasks by its words; what is left is a count per
    doc with partial sums."""
    words = docs.select(doc, F.explode_outer(F.array_distinct(split_words(text))).alias("word"))
    return words.distinct().groupBy(doc).agg(F.count("word").alias("n_words"))


def corpus_sizes(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row: n_docs (texts), max_distinct (largest distinct count of a text)
    and sum_distinct (sum of the distinct counts, i.e. the partial pairs a merge
    step receives)."""
    d = distinct_words_per_doc(docs, doc, text)
    return d.agg(F.count(F.lit(1)).alias("n_docs"),
                 F.max("n_words").alias("max_distinct"),
                 F.sum("n_words").alias("sum_distinct"))


def letter_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """(letter, n) for the 26 lower-case letters over all texts (0 if absent).

    Other characters are dropped inside each row, the letters are generated
    and counted in the same code-generated stage (partial aggregation), so
    only 26 partial counts per task reach the shuffle; the final <= 26 rows
    are pivoted against the fixed letter list and unpivoted back."""
    only = F.regexp_replace(F.col(text), f"[^{LETTERS[0]}-{LETTERS[-1]}]+", "")
    chars = docs.select(F.explode(F.split(only, "")).alias("letter")).where(F.col("letter") != "")
    counts = chars.groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    wide = counts.groupBy().pivot("letter", list(LETTERS)).agg(F.first("n"))
    wide = wide.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in LETTERS])
    return wide.unpivot([], list(LETTERS), "letter", "n")


def letter_count_per_doc(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, letter, n) for letters occurring in each text (no shuffle)."""
    wide = docs.select(doc, *[letter_occurrences(text, c).cast("bigint").alias(c) for c in LETTERS])
    return wide.unpivot([doc], list(LETTERS), "letter", "n").where(F.col("n") > 0)
