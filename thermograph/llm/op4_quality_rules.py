"""Quality rules, line first: lines are judged one by one, failing lines are
removed, and a document that loses too much of its text is rejected.

Rules for a line with ``n`` words (runs without ASCII white space):

* navigation: at least 3 of ``|`` and ``>``, and at least one per 5 words;
* punctuation: over 15 % of its characters are ``#*$%&|<>!?``;
* menu entry: fewer than 8 words and none of ``.!?;:``;
* boilerplate: at most 40 words and one of ``BOILERPLATE`` in it;
* repetition: equal to an earlier line of the same text.

A document is rejected if it has fewer than 50 words, if over half of its
words are in three-word windows found twice or more, or if the kept lines hold
less than half of its characters.  Everything is decided inside a row: no
shuffle, no state, whole texts, all rules on numpy arrays over many texts.

Nulls: a null text has no words and is rejected; its cleaned text is null.  A
null or repeated id is kept as it is, one row per input row.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.llm._groups import with_length
from thermograph.llm._text import U64, Words, mix, text_slices, windows

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MIN_KEPT_PCT = 50
BOILERPLATE = (
    "all rights reserved", "back to top", "click here", "cookie", "copyright", "follow us",
    "javascript", "log in", "lorem ipsum", "newsletter", "powered by", "privacy policy",
    "read more", "share this", "sign in", "sign up", "skip to content", "subscribe to",
    "terms of service", "terms of use",
)
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "kept", "n_lines", "n_failed_lines", "kept_chars"]
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, n_failed_lines long, kept_chars long")


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _NAV = _table("#*$%&|<>"), _table("|>")
_LOUD, _STOP = _table("#*$%&|<>!?"), _table(".!?;:")
_SPACES = _table(" \t\n\x0b\x0c\r")


def _sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive edges."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return np.diff(total[edges])


def _repeat_words(words: Words, n_rows: int) -> np.ndarray:
    h, at = windows(words.hashes(), words.doc, 3)
    if not len(h):
        return np.zeros(n_rows, np.int64)
    h = mix(h ^ mix(words.doc[at].astype(U64) + U64(1)))
    order = np.argsort(h)
    s = h[order]
    same = np.zeros(len(s), bool)
    same[1:] = s[1:] == s[:-1]
    same[:-1] |= same[1:]
    inside = np.zeros(len(words.doc) + 2, bool)
    hit = at[order[same]]
    for k in range(3):
        inside[hit + k] = True
    return np.bincount(words.doc[inside[:-2]], minlength=n_rows)


def judge(texts: pa.Array) -> tuple[dict[str, np.ndarray], list[str]]:
    """The measures of each text and its kept lines, joined."""
    n = len(texts)
    words = Words(texts)
    raw, off = words.raw, words.off
    strings = texts.to_pylist()
    lines = [s.split("\n") for s in strings]
    n_lines = np.array([len(x) for x in lines], np.int64)
    first_line = np.concatenate(([0], np.cumsum(n_lines)))
    line_doc = np.repeat(np.arange(n), n_lines)
    # Byte edges of lines: each text's begin, and after each of its newlines.
    begin = np.sort(np.concatenate((off[:-1], np.flatnonzero(raw == 10) + 1)), kind="stable")
    edges = np.append(begin, len(raw))
    word_of = np.searchsorted(words.start, edges)
    line_words = np.diff(word_of)
    visible = ((raw & 0xC0) != 0x80) & ~_SPACES[raw]
    chars = _sums(visible, edges)
    fail = (_sums(_NAV[raw], edges) >= 3) & (5 * _sums(_NAV[raw], edges) >= line_words)
    fail |= 100 * _sums(_LOUD[raw], edges) > 15 * chars
    fail |= (line_words < 8) & (_sums(_STOP[raw], edges) == 0)
    lower = raw.copy()
    lower[(raw >= 0x41) & (raw <= 0x5A)] += 32
    flat = lower.tobytes()
    boiler = np.zeros(len(begin), bool)
    for phrase in BOILERPLATE:
        p = phrase.encode()
        at = flat.find(p)
        while at >= 0:
            line = int(np.searchsorted(begin, at, side="right")) - 1
            if at + len(p) <= edges[line + 1]:
                boiler[line] = True
            at = flat.find(p, at + 1)
    fail |= boiler & (line_words <= 40)
    again = np.zeros(len(begin), bool)
    k = 0
    for own in lines:
        seen = set()
        for line in own:
            if line in seen:
                again[k] = True
            else:
                seen.add(line)
            k += 1
    has_word = line_words > 0
    fail = has_word & (fail | again)
    by_doc = lambda x: np.bincount(line_doc, weights=x, minlength=n).astype(np.int64)
    word_chars = by_doc(chars)
    kept_chars = by_doc(np.where(fail, 0, chars))
    n_words = np.diff(words.first).astype(np.int64)
    repeat = _repeat_words(words, n)
    base = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * n_words)
    out = {
        "n_words": n_words, "word_chars": word_chars,
        "n_symbols": _sums(_SYMBOL[raw], off), "n_dup_lines": by_doc(has_word & again),
        "n_repeat_words": repeat, "base_failed": base,
        "kept": ~base & (100 * kept_chars >= MIN_KEPT_PCT * word_chars),
        "n_lines": by_doc(has_word), "n_failed_lines": by_doc(fail), "kept_chars": kept_chars,
    }
    clean = []
    for d in range(n):
        bad = fail[first_line[d]:first_line[d + 1]]
        clean.append("\n".join(x for x, f in zip(lines[d], bad, strict=True) if not f)
                     if bad.any() else strings[d])
    return out, clean


def _run(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_text")
            for i, j, texts in text_slices(column):
                values, clean = judge(texts)
                arrays = [batch.column("_id").slice(i, j - i)]
                arrays += [pa.array(values[c]) for c in COLUMNS]
                names = ["_id", *COLUMNS]
                if with_text:
                    null = column.slice(i, j - i).is_null().to_numpy(zero_copy_only=False)
                    arrays.append(pa.array(clean, pa.string(), mask=null))
                    names.append("_clean")
                yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            with_text: bool = False) -> DataFrame:
    """One row per document: ``id_col``, the measures, the verdict ``kept``, and
    ``clean_text`` (its kept lines) if asked for."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, {SCHEMA}"
    out = rows.mapInArrow(_run(with_text), schema + (", _clean string" if with_text else ""))
    out = out.withColumnRenamed("_id", id_col)
    return out.withColumnRenamed("_clean", "clean_text") if with_text else out


def clean(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents that are kept, with all their columns and the cleaned text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for i, j, texts in text_slices(batch.column(at)):
                values, lines = judge(texts)
                rows = batch.slice(i, j - i).set_column(
                    at, batch.schema.field(at), pa.array(lines, batch.schema.field(at).type))
                yield rows.filter(pa.array(values["kept"]))
    return with_length(docs.mapInArrow(run, docs.schema), text_col, length_col)


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Measures and verdict of all ``documents``."""
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
