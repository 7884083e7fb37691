"""Word and letter counts: tokenizer edges and the eight-file corpus."""

import pytest
from pyspark.sql import functions as F

from thermograph.functions.text import split_words
from thermograph.operators.words import (corpus_sizes, distinct_words_per_doc, letter_count,
                                         letter_count_per_doc, word_count, word_count_per_doc)
from thermograph.sources.text import read_text_files, read_text_lines

# The eight input files of the distributed word count (no trailing newline).
FILES = {
    "in0": "helloworld ciao prova prova2 prova3",
    "in1": "hellpworld prova4",
    "in2": "helloworld",
    "in3": "helcoworld",
    "in4": "helloworld",
    "in5": "helloworld",
    "in6": "helloworld",
    "in7": "helloworld",
}


@pytest.mark.parametrize("text,tokens", [
    ("", [""]), ("\n", [""]), ("a b\n", ["a", "b"]), ("a\n\n", ["a", ""]),
    ("a  b", ["a", "", "b"]), ("a\tb\r\nc", ["a\tb\r", "c"]), (" a", ["", "a"]),
])
def test_tokenizer(spark, text, tokens):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(split_words("text").alias("w")).first().w == tokens


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("files")
    for name, text in FILES.items():
        (d / name).write_text(text)
    return read_text_files(spark, str(d))


def test_word_count_eight_files(corpus):
    got = {r.word: r.n for r in word_count(corpus, "doc").collect()}
    assert got == {"helloworld": 6, "ciao": 1, "prova": 1, "prova2": 1, "prova3": 1,
                   "prova4": 1, "hellpworld": 1, "helcoworld": 1}


def test_first_four_files(corpus):
    four = corpus.where(F.col("doc").rlike("in[0-3]$"))
    got = {r.word: r.n for r in word_count(four, "doc").collect()}
    assert got["helloworld"] == 2 and sum(got.values()) == 9


def test_per_doc_and_sizes(corpus):
    per = {(r.doc.rsplit("/", 1)[-1], r.word): r.n for r in word_count_per_doc(corpus, "doc").collect()}
    assert per[("in0", "prova")] == 1 and per[("in2", "helloworld")] == 1
    d = {r.doc.rsplit("/", 1)[-1]: r.n_words for r in distinct_words_per_doc(corpus, "doc").collect()}
    assert d["in0"] == 5 and d["in1"] == 2 and d["in7"] == 1
    s = corpus_sizes(corpus, "doc").first()
    assert (s.n_docs, s.max_distinct, s.sum_distinct) == (8, 5, 13)


def test_totals_property(spark):
    docs = spark.createDataFrame([(1, "a b a\n"), (2, "b  c"), (3, "")], "doc_id long, text string")
    total = {r.word: r.n for r in word_count(docs).collect()}
    per = word_count_per_doc(docs).groupBy("word").agg(F.sum("n").alias("n"))
    assert total == {r.word: r.n for r in per.collect()}
    assert total == {"a": 2, "b": 2, "c": 1, "": 2}


def test_letters(spark):
    docs = spark.createDataFrame([(1, "Hello world"), (2, "zz top")], "doc_id long, text string")
    got = {r.letter: r.n for r in letter_count(docs).collect()}
    assert len(got) == 26 and got["l"] == 3 and got["z"] == 2 and got["h"] == 0 and got["a"] == 0
    per = {(r.doc_id, r.letter): r.n for r in letter_count_per_doc(docs).collect()}
    assert per[(2, "z")] == 2 and (1, "a") not in per


def test_rows_that_repeat_doc_are_added_up(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b a"), (1, "b"), (2, "a"), (None, "c"), (None, "c")],
                                 "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.word, r.n) for r in word_count_per_doc(docs).collect())
    assert got == [(0, "c", 2), (1, "a", 2), (1, "b", 2), (2, "a", 1)]
    (tmp_path / "x").write_text("a b\na c\nb a")
    (tmp_path / "y").write_text("a\na")
    per = [sorted(map(tuple, word_count_per_doc(read(spark, str(tmp_path)), "doc").collect()))
           for read in (read_text_lines, read_text_files)]
    assert per[0] == per[1] and [n for _, _, n in per[0]] == [3, 2, 1, 2]
