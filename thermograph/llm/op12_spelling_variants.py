"""Spelling variant grouping by dynamic programming over sorted word lists.

Vocabulary: maximal runs of ``A-Za-z`` and U+00C0-U+00FF with A-Z lower-cased; of
a run whose crc32 (with its document's id) 97 divides, one code point is left out,
which plants misspellings.  Words have ``MIN_LENGTH`` code points and ``MIN_COUNT``
occurrences.  Two words are near if one inserted, deleted or replaced code point
makes one of the other; a word's form is its most frequent near word, if that is
at least ``RATIO`` times as frequent.

1. *Shards.*  Of two near words, the shorter of ``L`` code points, both begin with
   the same ``L // 2`` or end with the same ``L - L // 2``.  Each word is listed
   under its first and last half, as the shorter and as the longer of a pair.  A
   shard of over ``SHARD`` words is split by halves of what is left between, again
   and again; in the end its words differ in one place only, so that its size is
   bounded by the alphabet.  A pair is reported by the first shard that holds it:
   shards that split off by the end skip pairs that agree on the beginning too.
2. *Scan.*  A task sorts its shards' words (by the end of the word, where the end
   is shared) and scans the list with one band of the edit matrix, three cells wide,
   per query and range of words with a common prefix.  The adjacent longest common
   prefixes say where a range splits, so the row of a shared prefix is computed
   once for all its words, and a range is skipped as soon as its whole band exceeds
   one edit.  Queries move through the list together, a depth at a time.
3. *Roots.*  Each form is at least ``RATIO`` times as frequent as the word, so that
   chains are short; they are followed by pointer jumping on a written table.

Nulls: a null text has no words, a null ``doc_id`` counts as an empty string in the
crc.  Repeated rows and ids: each row counts.  Ties between forms go to the
smallest in code-point order.  Long texts and words are taken whole.  An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermograph.llm._groups import written

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLANT = 97  # runs whose crc this divides lose a code point
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
SHARD = 1024  # words of a shard that is not split further, if it can be split
BLOCK = 1 << 15  # words that a task scans together, unless one shard has more
FRONTIER = 1 << 21  # (query, range) pairs that a scan may come to hold
FAR = 2  # any distance above one edit


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all ``docs``."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER),
                                       F.lit(RUN), F.lit(0))).alias("run"))
    crc = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    cut = F.expr("concat(substr(run, 1, int(h % length(run))), substr(run, int(h % length(run)) + 2))")
    words = runs.withColumn("h", crc).select(
        F.when(F.col("h") % PLANT == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where((F.length("word") >= min_length) & (F.col("n") >= min_count)))


def _shard(part: Column) -> list[Column]:
    """Columns of a shard's row: the key names what its words have in common.

    ``small``: code points of the pair's shorter word; ``a`` / ``b``: those shared
    at the beginning / end; ``cap``: pairs that agree on so many at the beginning
    are left to another shard (0: none are)."""
    return [part["small"].alias("small"), part["a"].alias("a"), part["b"].alias("b"),
            part["cap"].alias("cap")]


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``; words hold letters only, so ``|`` separates."""
    return rows.withColumn("key", F.concat_ws(
        "|", "small", "a", "b", F.expr("substr(word, 1, a)"), F.expr("right(word, b)")))


def _halves(small: Column, a: Column, b: Column, cap: Column) -> Column:
    """The two shards that what is left between ``a`` and ``b`` is split into."""
    half = F.floor((small - a - b) / 2).cast("int")
    first = F.struct(small.alias("small"), (a + half).alias("a"), b.alias("b"), cap.alias("cap"))
    # Agreement on a + half is the first half's business; of several such rules
    # the shortest beginning decides.
    rule = F.when((cap > 0) & (cap < a + half), cap).otherwise(a + half)
    last = F.struct(small.alias("small"), a.alias("a"), (small - a - half).alias("b"),
                    rule.alias("cap"))
    return F.explode(F.array(first, last))


def shards(words: DataFrame, limit: int = SHARD) -> DataFrame:
    """(word, n, small, a, b, cap, key): each word once per shard."""
    spark = words.sparkSession
    zero = F.lit(0)
    small = words.select("*", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("small"))
    rows = small.select("word", "n", _halves(F.col("small"), zero, zero, zero).alias("s"))
    rows = _named(rows.select("word", "n", *_shard(F.col("s"))))
    done = None
    while True:
        rows = written(spark, rows, "op12-shards")
        # What one place sets apart can't be split; neither can two.
        large = rows.where("small - a - b > 1").groupBy("key").agg(F.count(F.lit(1)).alias("m"))
        large = large.where(F.col("m") > limit).select("key")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        rest = rows.join(large, "key", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        split = rows.join(large, "key", "left_semi")
        split = split.select("word", "n", _halves(*[F.col(c) for c in ("small", "a", "b", "cap")])
                             .alias("s"))
        rows = _named(split.select("word", "n", *_shard(F.col("s"))))


class SortedList:
    """Words of many shards, sorted by (shard, word), as arrays of code points.

    ``lcp[i]``: code points that words i - 1 and i share, -1 between shards."""

    def __init__(self, words: list[str], shard: np.ndarray):
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        new = np.ones(len(words), bool)
        new[1:] = shard[1:] != shard[:-1]
        self.lcp = np.full(len(words) + 1, -1, np.int64)
        at = np.flatnonzero(~new)
        depth = 0
        while len(at):  # those that agree on one more code point go on
            self.lcp[at] = depth
            same = self.char(at, depth) == self.char(at - 1, depth)
            at = at[same & (self.length[at] > depth) & (self.length[at - 1] > depth)]
            depth += 1
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(words))

    def char(self, word: np.ndarray, at) -> np.ndarray:
        """The code point at a place of each word, -1 beyond its ends."""
        inside = (at >= 0) & (at < self.length[word])
        place = np.where(inside, self.start[word] + at, 0)
        return np.where(inside, self.flat[place], -1) if len(self.flat) else np.full(len(word), -1)


def scan(words: SortedList, query: np.ndarray, depth: np.ndarray
         ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, word) pairs at a distance of one edit within the queries' shards.

    All words of a query's shard share the first ``depth`` code points."""
    of = np.searchsorted(words.first, query, side="right") - 1
    order = np.argsort(depth, kind="stable")
    query, of, depth = query[order], of[order], depth[order]
    by_lcp = np.argsort(words.lcp[:-1], kind="stable")
    lcp = words.lcp[by_lcp]
    q = lo = hi = np.zeros(0, np.int64)
    band = np.zeros((3, 0), np.int8)
    d = int(depth[0]) if len(depth) else 0
    begun = 0
    while begun < len(query) or len(q):
        # Queries whose shard's common prefix ends here join with the row of an
        # exact match: d code points against d - 1, d and d + 1 of the query.
        to = int(np.searchsorted(depth, d, side="right"))
        if to > begun:
            fresh = slice(begun, to)
            row = np.tile(np.array([[1], [0], [1]], np.int8), to - begun)
            q = np.concatenate((q, query[fresh]))
            lo = np.concatenate((lo, words.first[of[fresh]]))
            hi = np.concatenate((hi, words.last[of[fresh]]))
            band = np.concatenate((band, row), axis=1)
            begun = to
        if not len(q):
            d = int(depth[begun])
            continue
        # Words that end here come first in their range.
        ends = words.length[lo] == d
        while ends.any():
            at = np.flatnonzero(ends)
            side = words.length[q[at]] - d  # where the query's end lies in the band
            near = (np.abs(side) <= 1) & (band[np.clip(side, -1, 1) + 1, at] == 1)
            yield q[at[near]], lo[at[near]]
            lo = lo + ends
            ends = np.zeros(len(lo), bool)
            more = at[lo[at] < hi[at]]
            ends[more] = words.length[lo[more]] == d
        keep = lo < hi
        q, lo, hi, band = q[keep], lo[keep], hi[keep], band[:, keep]
        if not len(q):
            d += 1
            continue
        # Ranges split where neighbours share d code points and no more.
        cuts = np.sort(by_lcp[np.searchsorted(lcp, d):np.searchsorted(lcp, d, side="right")])
        a = np.searchsorted(cuts, lo, side="right")
        n = np.searchsorted(cuts, hi, side="left") - a + 1
        parent = np.repeat(np.arange(len(q)), n)
        k = np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n)
        inner = np.append(cuts, -1)
        begin = np.where(k == 0, lo[parent], inner[np.minimum(a[parent] + k - 1, len(cuts))])
        end = np.where(k == n[parent] - 1, hi[parent], inner[np.minimum(a[parent] + k, len(cuts))])
        q, lo, hi, band = q[parent], begin, end, band[:, parent]
        # The next row of the band, with the range's next code point.
        c = words.char(lo, d)
        size = words.length[q]
        differs = [c != words.char(q, d + j) for j in (-1, 0, 1)]
        low = np.minimum(band[0] + differs[0], band[1] + 1)
        mid = np.minimum(np.minimum(band[1] + differs[1], band[2] + 1), low + 1)
        high = np.minimum(band[2] + differs[2], mid + 1)
        # Cells beyond the query's ends do not exist.
        low = np.where((d >= 1) & (d <= size), low, np.where(d == 0, d + 1, FAR))
        mid = np.where(d + 1 <= size, mid, FAR)
        high = np.where(d + 2 <= size, high, FAR)
        band = np.minimum(np.stack((low, mid, high)), FAR).astype(np.int8)
        keep = band.min(axis=0) <= 1
        q, lo, hi, band = q[keep], lo[keep], hi[keep], band[:, keep]
        d += 1


def near_in_block(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(shorter, other) rows of near words in a block of whole shards."""
    key = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
    count = np.bincount(key)
    rows = np.flatnonzero(count[key] > 1)  # who is alone has nobody near
    if not len(rows):
        return
    key = key[rows]
    word = table.column("word").take(pa.array(rows)).to_pylist()
    small, a, b, cap = (table.column(c).to_numpy()[rows] for c in ("small", "a", "b", "cap"))
    back = b > a  # lists of words with a common end are sorted from the end
    text = [w[::-1] if r else w for w, r in zip(word, back.tolist(), strict=True)]
    order = np.array(sorted(range(len(text)), key=lambda i: (key[i], text[i])), np.int64)
    listed = SortedList([text[i] for i in order], key[order])
    query = np.flatnonzero(listed.length == small[order])
    depth = np.where(back, b, a)[order]
    cut, length = cap.tolist(), np.array([len(w) for w in word], np.int64)
    step = max(1, FRONTIER // int(count[key].max()))
    for i in range(0, len(query), step):
        part = query[i:i + step]
        for x, y in scan(listed, part, depth[part]):
            x, y = order[x], order[y]
            # Of two words of the same length both are queries.
            new = (length[x] < length[y]) | (x < y)
            x, y = x[new], y[new]
            new = np.array([not cut[i] or word[i][:cut[i]] != word[j][:cut[i]]
                            for i, j in zip(x.tolist(), y.tolist(), strict=True)], bool)
            yield rows[x[new]], rows[y[new]]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, other, other_n), in both directions, from rows sorted by key."""
    def block(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for x, y in near_in_block(table):
            if not len(x):
                continue
            x, y = pa.array(np.concatenate((x, y))), pa.array(np.concatenate((y, x)))
            out = pa.table([table.column("word").take(x), table.column("word").take(y),
                            table.column("n").take(y)], ["word", "other", "other_n"])
            yield from out.combine_chunks().to_batches()

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < BLOCK:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        key = table.column("key").chunk(0)
        same = pa.compute.equal(key, key[len(key) - 1]).to_numpy(zero_copy_only=False)
        at = len(same) - int(same.sum())  # the last shard may go on in the next batch
        if at:
            yield from block(table.slice(0, at))
        held = table.slice(at).to_batches()
        size = len(same) - at
    if size:
        yield from block(pa.Table.from_batches(held).combine_chunks())


def near_words(words: DataFrame, limit: int = SHARD) -> DataFrame:
    """(word, other, other_n): near pairs of ``words`` (word, n), both ways."""
    rows = shards(words, limit).select("key", "word", "n", "small", "a", "b", "cap")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        _near, "word string, other string, other_n long")


def variant_groups(words: DataFrame, ratio: int = RATIO, limit: int = SHARD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``words`` (word, n)."""
    spark = words.sparkSession
    words = written(spark, words.select("word", "n"), "op12-words")
    best = near_words(words, limit).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    found = written(spark, found.select(
        "word", "n", "n_near", F.col("best.other").alias("form"),
        (-F.col("best.less")).alias("form_n")), "op12-forms")
    up = written(spark, found.where("form is not null").select("word", F.col("form").alias("root")),
                 "op12-roots")
    while True:  # each round doubles the length of the chains that are followed
        far = up.select(F.col("word").alias("root"), F.col("root").alias("far"))
        up = written(spark, up.join(far, "root", "left").select(
            "word", F.coalesce("far", "root").alias("root"),
            F.col("far").isNotNull().alias("moved")), "op12-roots")
        if up.where("moved").isEmpty():
            break
        up = up.drop("moved")
    return found.join(up.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Variants, forms and roots of the vocabulary of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variant_groups(vocabulary(docs))
