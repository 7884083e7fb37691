"""Line dedup with a log-template tree.

A line is its words (runs without ASCII white space); a word with a digit is a
variable field.  The tree has a fixed depth: the number of words, then the
``DEPTH`` leading words (variables as one).  Within a leaf, a word's support is
the number of documents whose lines have it at its place.  The level of a line
is the support that its best supported words reach, ``SIMILAR`` % of all words
(the leading ones among them).  Words supported by at most half of the level are
variable fields too, never more than the rest of the words.  A line's template
is the line with the leaf's best supported word of the place (ties: the smallest
hash) in each variable field: lines of one template each equal it in
``SIMILAR`` % of their words or more.

Only ratios of supports count, so a template is found alike at every size, in
whatever order lines come.  A leaf of up to ``LEAF_WORDS`` words in different
lines is done in one task.  The words of a larger one are spread: supports are an
aggregate by (leaf, place, word), joined back, and each line is put together
again; a fixed number of jobs, with work in proportion to the words.

A template recurs if at least two documents have it and documents times words
reach ``WEIGHT``: long lines recur from the second document on, short ones need
more.  Its lines stay in the first document (lowest id) and are dropped from
all others.

Before anything is shuffled a task adds up equal lines, so a line in a third of
all documents is a few rows per task; an aggregate adds up the tasks' rows
before any leaf is gathered.  Words travel as 16-bit hashes.  The
decisions, not the texts, are joined back, by the line's hash.

Nulls: a null text has no lines and stays null; a row with a null id is never
first and keeps all its lines.  Rows that repeat an id are one document.
Blank lines are kept as they are.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermograph.llm._groups import free_name, with_length, written
from thermograph.llm._text import U64, Words, mix, powers, text_slices

DEPTH = 3
SIMILAR = 70
LEAF_WORDS = 1 << 20  # words of a leaf that a task holds; no result depends on it
WEIGHT = 20
# Lines to drop up to which they are broadcast to the texts; beyond, a join shuffles.
BROADCAST_ROWS = 1_000_000
SALT_LINES = 1 << 18  # lines of a large leaf that one group of a join may hold
HELD = 64 << 20  # bytes of different lines that a task adds up before it sends them on
ROW_BYTES = 300  # what a held line takes beside its words

_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_VARIABLE = mix(np.array([42], U64))[0]
_Q = U64(0x9FB21C651E98DF25)


class Lines:
    """Hashed lines of a slice of texts, those with a word only: ``doc``,
    ``leaf``, ``hash``, ``size`` (words) and ``word`` (16-bit hashes)."""

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        h = words.hashes()
        digits = np.concatenate(([0], np.cumsum(_DIGIT[words.raw])))
        h[digits[words.end] > digits[words.start]] = _VARIABLE
        raw = words.raw
        edges = np.unique(np.concatenate((words.off[:-1], np.flatnonzero(raw == 10) + 1)))
        line = np.searchsorted(edges, words.start, side="right")
        new = np.ones(len(h), bool)
        new[1:] = (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])
        self.first = np.flatnonzero(new)
        self.size = np.diff(self.first, append=len(h))
        self.doc = words.doc[self.first]
        self.word = (h >> U64(48)).astype(np.uint16)
        if not len(h):
            self.hash = self.leaf = np.zeros(0, np.int64)
            return
        inside = np.arange(len(h)) - np.repeat(self.first, self.size)
        part = h * powers(int(self.size.max()), _Q)[inside]
        salt = self.size.astype(U64) * U64(0xC2B2AE3D27D4EB4F)
        self.hash = mix(np.add.reduceat(part, self.first) + salt).view(np.int64)
        part[inside >= DEPTH] = 0
        self.leaf = mix(np.add.reduceat(part, self.first) ^ salt).view(np.int64)

    def words_of(self, i: int) -> bytes:
        return self.word[self.first[i]:self.first[i] + self.size[i]].tobytes()


def _first_per_doc(lines: Lines) -> np.ndarray:
    """Indices of lines, each different one of a document once."""
    order = np.lexsort((lines.hash, lines.doc))
    d, h = lines.doc[order], lines.hash[order]
    keep = np.ones(len(order), bool)
    keep[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return np.sort(order[keep])


def _count(id_type: pa.DataType):
    names = ["leaf", "line", "size", "n_docs", "first", "words"]

    def rows(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v[0] for v in held.values()], pa.int64()), pa.array(list(held), pa.int64()),
             pa.array([v[1] for v in held.values()], pa.int32()),
             pa.array([v[2] for v in held.values()], pa.int64()),
             pa.array([v[3] for v in held.values()], id_type),
             pa.array([v[4] for v in held.values()], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        room = HELD
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            for i, _, texts in text_slices(batch.column("_text")):
                lines = Lines(texts)
                leaf, line, size, doc = (x.tolist() for x in (
                    lines.leaf, lines.hash, lines.size, lines.doc))
                for at in _first_per_doc(lines).tolist():
                    own = ids[i + doc[at]]
                    got = held.get(line[at])
                    if got is None:
                        held[line[at]] = [leaf[at], size[at], 1, own, lines.words_of(at)]
                        room -= ROW_BYTES + 2 * size[at]
                        if room <= 0:
                            yield rows(held)
                            held, room = {}, HELD
                    else:
                        got[2] += 1
                        if got[3] is None or own is not None and own < got[3]:
                            got[3] = own
        if held:
            yield rows(held)
    return run


def cluster(words: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Template number of each line of a leaf; ``words``: one row per line."""
    m, size = words.shape
    free = size - DEPTH
    if m == 1 or free <= 0:
        return np.zeros(m, np.int64)
    place = (np.arange(free, dtype=np.int64) << 16) + words[:, DEPTH:]
    found, at = np.unique(place, return_inverse=True)
    at = at.reshape(m, free)
    total = np.bincount(at.ravel(), weights=np.repeat(weight, free)).astype(np.int64)
    support = total[at]
    level = np.partition(support, free - _held(size), axis=1)[:, free - _held(size)]
    order = np.lexsort((found, -total, found >> 16))
    usual = found[order[np.concatenate(([True], np.diff(found[order] >> 16) > 0))]]
    whole = np.where(2 * support <= level[:, None], usual, place)
    return np.unique(whole, axis=0, return_inverse=True)[1].reshape(m)


def _held(size: int) -> int:
    """How many of the words after the leading ones set a line's level."""
    return max(1, -(-SIMILAR * size // 100) - DEPTH)


def _leaf(line, size, n_docs, first, words) -> Iterator[tuple[int, object]]:
    """(line, first document) for the lines of recurring templates of a leaf."""
    places: dict[int, int] = {}
    docs: list[int] = []
    low: list = []
    text: list[bytes] = []
    for h, n, f, w in zip(line, n_docs, first, words, strict=True):
        at = places.setdefault(h, len(docs))
        if at == len(docs):
            docs.append(0)
            low.append(f)
            text.append(w)
        docs[at] += n
        if low[at] is None or f is not None and f < low[at]:
            low[at] = f
    if sum(docs) < 2 or sum(docs) * size < WEIGHT:
        return
    # In the order of the hashes: rows arrive in any order, templates must not.
    order = sorted(places, key=places.get)
    rank = sorted(range(len(order)), key=order.__getitem__)
    order, docs, low, text = ([x[k] for k in rank] for x in (order, docs, low, text))
    weight = np.array(docs)
    if len(docs) == 1:
        kind = np.zeros(1, np.int64)
    else:
        kind = cluster(np.frombuffer(b"".join(text), np.uint16).reshape(len(docs), -1), weight)
    total = np.bincount(kind, weights=weight)
    least: dict[int, object] = {}
    for k, f in zip(kind.tolist(), low, strict=True):
        if f is not None and (least.get(k) is None or f < least[k]):
            least[k] = f
    for h, k in zip(order, kind.tolist(), strict=True):
        if total[k] >= 2 and total[k] * size >= WEIGHT:
            yield h, least.get(k)


def _recurring(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(tables).combine_chunks()
            leaf, size = t.column("leaf").to_numpy(), t.column("size").to_numpy()
            n = t.column("n_docs").to_numpy()
            # Sizes too: hashes of leaves may collide.
            begin = np.flatnonzero(np.concatenate(
                ([True], (leaf[1:] != leaf[:-1]) | (size[1:] != size[:-1]))))
            end = np.append(begin[1:], len(leaf))
            lines, firsts = [], []
            for i, j in zip(begin.tolist(), end.tolist(), strict=True):
                if j - i == 1 and n[i] < 2:
                    continue
                part = t.slice(i, j - i)
                for h, f in _leaf(part.column("line").to_pylist(), part.column("size")[0].as_py(),
                                  part.column("n_docs").to_pylist(),
                                  part.column("first").to_pylist(),
                                  part.column("words").to_pylist()):
                    lines.append(h)
                    firsts.append(f)
            return pa.RecordBatch.from_arrays(
                [pa.array(lines, pa.int64()), pa.array(firsts, id_type)], ["line", "first"])

        for batch in batches:
            if not len(batch):
                continue
            # What is held ends with an unfinished leaf.
            leaf = batch.column("leaf").to_numpy()
            last = int((leaf == leaf[-1]).argmax())
            if last or held and held[-1].column("leaf")[-1].as_py() != leaf[0]:
                yield done([*held, batch.slice(0, last)] if last else held)
                held = []
            held.append(batch.slice(last))
        if held:
            yield done(held)
    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per word after the leading ones: place (position and word)."""
    for batch in batches:
        if not len(batch):
            continue
        size = batch.column("size").to_numpy()
        # About a million words at a time: a batch may hold very long lines.
        edge = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + (1 << 20), 1 << 20))
        for i, j in zip(edge[:-1].tolist(), [*edge[1:-1].tolist(), len(size)], strict=True):
            if i == j:
                continue
            part, n = batch.slice(i, j - i), size[i:j]
            word = np.frombuffer(b"".join(part.column("words").to_pylist()), np.uint16)
            inside = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
            keep = inside >= DEPTH
            row = pa.array(np.repeat(np.arange(len(n)), n)[keep])
            place = (inside[keep].astype(np.int64) << 16) + word[keep]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(row) for c in ("leaf", "salts", "line", "n_docs", "size")),
                 pa.array(place)], ["leaf", "salts", "line", "n_docs", "size", "place"])


def _large(lines: DataFrame, leaves: DataFrame) -> DataFrame:
    """(line, first) for the lines of recurring templates of large leaves: what
    ``cluster`` does, with the words as rows."""
    spark = lines.sparkSession
    own = written(spark, lines.join(leaves, "leaf"), "op6-large")
    places = written(spark, own.select("leaf", "salts", "line", "n_docs", "size", "words").mapInArrow(
        _places, "leaf long, salts long, line long, n_docs long, size int, place long"), "op6-places")
    support = places.groupBy("leaf", "place").agg(
        F.sum("n_docs").alias("support"), F.max("salts").alias("salts"))
    position = F.shiftright("place", 16)
    usual = support.groupBy("leaf", position.alias("position")).agg(
        (-F.max(F.struct("support", (-F.col("place")).alias("low")))["low"]).alias("usual"))
    known = support.withColumn("position", position).join(usual, ["leaf", "position"]).select(
        "leaf", "place", "support", "usual",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    held = F.greatest(F.lit(1), F.ceil(F.col("size") * SIMILAR / 100).cast("int") - DEPTH)
    shapes = places.withColumn("salt", F.pmod("line", "salts")).join(
        known, ["leaf", "place", "salt"]).groupBy("leaf", "line", "size").agg(
        F.sort_array(F.collect_list(F.struct("place", "support", "usual"))).alias("row"))
    level = F.element_at(F.sort_array(F.col("row.support"), asc=False), held)
    shapes = shapes.withColumn("level", level).select("leaf", "line", F.xxhash64(F.transform(
        "row", lambda x: F.when(2 * x["support"] <= F.col("level"), x["usual"]).otherwise(x["place"])
    )).alias("shape"))
    state = written(spark, own.select("leaf", "salts", "line", "size", "n_docs", "first").join(
        shapes, ["leaf", "line"]), "op6-shapes")
    kinds = state.groupBy("leaf", "shape").agg(
        F.sum("n_docs").alias("docs"), F.min("first").alias("first"), F.max("size").alias("size"),
        F.max("salts").alias("salts"))
    kinds = kinds.where(f"docs >= 2 and docs * size >= {WEIGHT}").select(
        "leaf", "shape", "first",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    return state.select("leaf", "line", "shape", F.pmod("line", "salts").alias("salt")).join(
        kinds, ["leaf", "shape", "salt"]).select("line", "first")


def _doc_lines(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id")
            for i, j, texts in text_slices(batch.column("_text")):
                lines = Lines(texts)
                at = _first_per_doc(lines)
                own = ids.slice(i, j - i).take(pa.array(lines.doc[at]))
                yield pa.RecordBatch.from_arrays([own, pa.array(lines.hash[at])], ["_id", "line"])
    return run


def _drop(text_at: int, gone_at: int, wordless: bool):
    """Rows without the lines in column ``gone_at``, then two counts; rows that
    lost all their words only if ``wordless``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, gone = batch.column(text_at), batch.column(gone_at)
            for i, j, texts in text_slices(column):
                lines = Lines(texts)
                edge = np.searchsorted(lines.doc, np.arange(j - i + 1))
                out, n_lines, n_gone = [], [], []
                for d in range(j - i):
                    own = lines.hash[edge[d]:edge[d + 1]]
                    n_lines.append(len(own))
                    value, drop = column[i + d].as_py(), gone[i + d].as_py()
                    if not drop:
                        out.append(value)
                        n_gone.append(0)
                        continue
                    bad = np.isin(own, np.array(drop, np.int64))
                    n_gone.append(int(bad.sum()))
                    left, k = [], 0
                    for s in value.split("\n"):
                        if s.strip(" \t\n\x0b\x0c\r"):
                            k += 1
                            if bad[k - 1]:
                                continue
                        left.append(s)
                    out.append("\n".join(left))
                rows = batch.slice(i, j - i)
                arrays = [pa.array(out, column.type) if c == text_at else rows.column(c)
                          for c in range(rows.num_columns) if c != gone_at]
                arrays += [pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64())]
                names = [n for c, n in enumerate(rows.schema.names) if c != gone_at]
                done = pa.RecordBatch.from_arrays(arrays, [*names, "_n_lines", "_n_dropped"])
                if not wordless:
                    n, g = np.array(n_lines), np.array(n_gone)
                    done = done.filter(pa.array((g == 0) | (g < n)))
                yield done
    return run


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(line, first): hash of each line that belongs to a recurring template, and
    the document that keeps the template."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType
    arrow, name = to_arrow_type(kind), kind.simpleString()
    counted = rows.mapInArrow(
        _count(arrow), f"leaf long, line long, size int, n_docs long, first {name}, words binary")
    lines = written(docs.sparkSession, counted.groupBy("leaf", "line", "size", "words").agg(
        F.sum("n_docs").alias("n_docs"), F.min("first").alias("first")), "op6-counted")
    leaves = written(docs.sparkSession, large_leaves(lines), "op6-leaves")
    n = leaves.count()
    known = F.broadcast(leaves) if n <= BROADCAST_ROWS else leaves
    small = lines.join(known, "leaf", "left_anti") if n else lines
    out = (small.select(*counted.columns).repartition("leaf").sortWithinPartitions("leaf", "size")
           .mapInArrow(_recurring(arrow), f"line long, first {name}"))
    return out.unionByName(_large(lines, known)) if n else out


def large_leaves(lines: DataFrame) -> DataFrame:
    """(leaf, salts) of the leaves of over ``LEAF_WORDS`` words in different lines."""
    return lines.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("m"), F.sum("size").alias("words")).where(
        f"m > 1 and words > {LEAF_WORDS}").select(
        "leaf", F.ceil(F.col("m") / SALT_LINES).cast("long").alias("salts"))


def _marked(docs: DataFrame, id_col: str, text_col: str, column: str) -> DataFrame:
    """``docs`` and, in ``column``, the hashes of the lines each is to lose."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType
    arrow, name = to_arrow_type(kind), kind.simpleString()
    again = written(spark, recurring_lines(docs, id_col, text_col), "op6-lines")
    own = rows.where("_id is not null").mapInArrow(_doc_lines(arrow), f"_id {name}, line long")
    drop = written(spark, own.join(again, "line").where("_id <> first").select("_id", "line"),
                   "op6-drop")
    few = drop.count() <= BROADCAST_ROWS
    key = free_name(docs, "_owner")
    gone = drop.groupBy(F.col("_id").alias(key)).agg(F.collect_set("line").alias(column))
    return docs.join(F.broadcast(gone) if few else gone, docs[id_col] == gone[key], "left").drop(key)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, text (without the dropped
    lines), n_lines (with a word), n_dropped."""
    rows = _marked(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")),
                   "_id", "text", "_gone")
    out = rows.mapInArrow(
        _drop(1, 2, True), f"_id {rows.schema['_id'].dataType.simpleString()}, text string, "
        "_n_lines long, _n_dropped long")
    return out.toDF(id_col, "text", "n_lines", "n_dropped")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               length_col: str = "n_chars") -> DataFrame:
    """``docs`` with all their columns, without the dropped lines; a document
    whose last word went with them goes too."""
    gone = free_name(docs, "_gone")
    rows = _marked(docs, id_col, text_col, gone)
    out_type = T.StructType([*docs.schema.fields, T.StructField("_n_lines", T.LongType()),
                             T.StructField("_n_dropped", T.LongType())])
    out = rows.mapInArrow(_drop(docs.columns.index(text_col), len(docs.columns), False), out_type)
    return with_length(out.toDF(*docs.columns, free_name(docs, "_a"), free_name(docs, "_b"))
                       .select(*docs.columns), text_col, length_col)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` without the lines that others have before them."""
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
