"""Source divergence audit by Gustavson row accumulation.

Within each language, how far is every source's use of terms from every other
source's, and which terms set a source apart from its language?  Terms are
maximal runs of ASCII letters and non-ASCII characters, A-Z lower-cased; a
language keeps the terms that at least ``MIN_DOCS`` of its documents (rows) hold.
A group's weight of a term is ``p = 1 + floor(SCALE * (count + 1) / (N + V))``, and
``f(p, q) = floor((p - q)**2 / q)``; everything is integer arithmetic.

The divergence of group g from peer h is the sum of f over all kept terms, most
of which neither has.  With p0 and q0 the weights at count 0, it is the sum of

* a zero baseline, ``V * f(p0, q0)``;
* what g's own terms change, ``f(p, q0) - f(p0, q0)``, and what h's own terms
  change, ``f(p0, q) - f(p0, q0)``: sums over the groups' histograms of counts;
* for the terms both have, ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)``.

The last sum is a sparse row-by-row product.  The term-major index is a written
table with one row per term and its postings, one per source that has it.  Tasks
read slices of it; each group's row of a slice scatters its terms through the index
into one dense accumulator over the slice's peers, and only the accumulators leave
the task: no posting pair is emitted.  Slices are cut into blocks of bounded size.

Counting adds up in the task first (bounded tables), so a frequent term or a hot
source costs a row per task; one shuffle by (language, term) then serves the sums,
the choice of terms and the index.  The groups' totals are joined to the postings:
by a broadcast up to ``BROADCAST_GROUPS`` groups, by shuffles beyond.

Nulls in text, lang and source are read as empty strings.  A group without terms
takes part with count 0; a language without kept terms has value 0 for all pairs
and no terms.  Repeated rows and ids: each row is a document.  Ties go by the
item in UTF-8 order.  An empty table gives an empty result.  Counts may reach
9e15 per language.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermograph.llm._groups import written
from thermograph.llm._text import text_slices

SCALE = 1_000_000_000
MIN_DOCS = 3  # documents of a language that hold a kept term
TOP_TERMS = 200  # ranks of a group's terms that are reported
TASK_TERMS = 300_000  # (group, term) counts that a task holds before it emits them
BLOCK = 1 << 19  # postings of a block of the index
BROADCAST_GROUPS = 100_000

# Bytes of UTF-8: A-Z to a-z, other letters and non-ASCII as they are, else a space.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20
                    for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TERM_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, c, d): occurrences and documents, added up in the task."""
    count: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in count.items():
            names = list(terms)
            with_term = docs[lang, source]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(names)), pa.array([source] * len(names)),
                 pa.array(names, pa.binary()).cast(pa.string()),
                 pa.array(list(terms.values()), pa.int64()),
                 pa.array([with_term[t] for t in names], pa.int64())],
                ["lang", "source", "term", "c", "d"])
        count.clear()
        docs.clear()

    held = 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for i, _, texts in text_slices(batch.column("text")):
            for at, text in enumerate(texts.cast(pa.large_binary()).to_pylist(), i):
                words = terms_of(text)
                if not words:
                    continue
                table = count[langs[at], sources[at]]
                before = len(table)
                table.update(words)
                docs[langs[at], sources[at]].update(set(words))
                held += len(table) - before
                if held > TASK_TERMS:
                    yield from flush()
                    held = 0
    yield from flush()


def weight(count: Column | str, total: Column | str) -> Column:
    """1 + floor(SCALE * (count + 1) / total), in wider numbers where the product
    leaves 64 bits; null for a total of 0."""
    total = F.col(total) if isinstance(total, str) else total
    total = F.when(total > 0, total)
    x = (F.col(count) if isinstance(count, str) else count) + F.lit(1).cast("long")
    wide = F.call_function("div", x.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"),
                           total.cast("decimal(20,0)"))
    return F.when(x <= (1 << 62) // SCALE, F.call_function("div", x * SCALE, total)
                  ).otherwise(wide) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _weights(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same by long division in steps of three digits, within 64 bits."""
    out, rest = np.ones(len(count), np.int64), count + 1
    for scale in (SCALE, SCALE // 10**3, SCALE // 10**6, 1):
        digits = rest // total
        out += digits * scale
        rest = (rest - digits * total) * 1000
    return out


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def accumulate_rows(term: np.ndarray, group: np.ndarray, p: np.ndarray, p0: np.ndarray
                    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, peers, corrections) of a block of the index of one language.

    The block is term-major: ``term`` ascends.  ``p``: the group's weight of the
    term, ``p0``: its weight at count 0."""
    begin = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
    length = np.diff(begin, append=len(term))
    of = np.repeat(np.arange(len(begin)), length)
    peers, dense = np.unique(group, return_inverse=True)
    rows = np.argsort(dense, kind="stable")
    ends = np.cumsum(np.bincount(dense, minlength=len(peers)))
    for g, (lo, hi) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
        mine = rows[lo:hi]
        n = length[of[mine]]
        # Places of the postings of all of the row's terms, one after the other.
        at = np.repeat(begin[of[mine]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        own, zero = np.repeat(p[mine], n), p0[mine[0]]
        q, q0 = p[at], p0[at]
        total = np.zeros(len(peers), np.int64)
        np.add.at(total, dense[at],
                  _apart(own, q) - _apart(own, q0) - _apart(zero, q) + _apart(zero, q0))
        total[g] = 0
        hit = np.flatnonzero(total)
        yield int(peers[g]), peers[hit], total[hit]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections (lid, g, h, value) of a slice; a term's postings are together."""
    def block(table: pa.Table) -> Iterator[pa.RecordBatch]:
        order = pa.compute.sort_indices(table, [("lid", "ascending"), ("term", "ascending")])
        table = table.take(order)
        col = {c: table.column(c).to_numpy() for c in ("lid", "gid", "c", "n", "v")}
        name = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        total = col["n"] + col["v"]
        p, p0 = _weights(col["c"], total), _weights(np.zeros(len(total), np.int64), total)
        cut = np.flatnonzero(np.diff(col["lid"])) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(total)], strict=True):
            s = slice(lo, hi)
            lid = int(col["lid"][lo])
            # Names are numbered as they come, so each term's number is one run.
            for g, peers, value in accumulate_rows(name[s], col["gid"][s], p[s], p0[s]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(peers), lid)), pa.array(np.full(len(peers), g)),
                     pa.array(peers), pa.array(value)], ["lid", "g", "h", "value"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < BLOCK:
            continue
        table = pa.Table.from_batches(held)
        # The last term may go on in the next batch.
        term, lid = table.column("term"), table.column("lid")
        last = table.num_rows - 1
        at = last
        while at > 0 and term[at - 1] == term[last] and lid[at - 1] == lid[last]:
            at -= 1
        if at:
            yield from block(table.slice(0, at))
        held = table.slice(at).to_batches()
        size = table.num_rows - at
    if size:
        yield from block(pa.Table.from_batches(held))


def term_index(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, lang_c, postings) of all kept terms of ``docs`` (lang, source,
    text); a posting (source, c) for each source that has the term."""
    part = docs.mapInArrow(_count, "lang string, source string, term string, c long, d long")
    # Dealt by (lang, term): both sums below find their rows in one place.
    counts = part.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("c").alias("c"), F.sum("d").alias("d"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("c").alias("lang_c"), F.sum("d").alias("d"),
        F.collect_list(F.struct("source", "c")).alias("postings"))
    return terms.where(F.col("d") >= min_docs).drop("d")


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
                      text_col: str = "text", min_docs: int = MIN_DOCS,
                      top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): for each (lang, source) group its
    divergence from all other sources of the language (part ``pair``), and the
    ``top_terms`` terms it uses more than its language (part ``term``)."""
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    index = written(spark, term_index(docs, min_docs), "op13-index")
    langs = index.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_c").alias("lang_n"))
    rows = index.select("lang", "term", "lang_c", F.explode("postings").alias("x")).select(
        "lang", "term", "lang_c", "x.source", "x.c")

    # One row per group: gid and lid number the groups and the languages.
    groups = (docs.groupBy("lang", "source").agg(F.lit(1).alias("_"))
              .join(rows.groupBy("lang", "source").agg(F.sum("c").alias("n")),
                    ["lang", "source"], "left").join(langs, "lang", "left"))
    by_lang = Window.partitionBy("lang").orderBy("source")
    groups = groups.select(
        "lang", "source", F.xxhash64("lang").alias("lid"),
        F.row_number().over(by_lang).cast("long").alias("gid"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "v", "lang_n")])
    groups = written(spark, groups, "op13-groups")
    few = groups.count() <= BROADCAST_GROUPS
    side = F.broadcast(groups) if few else groups
    full = rows.join(side, ["lang", "source"])

    pairs = _pairs(full, groups, few)
    over = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    names = groups.select("lang", "lid", F.col("gid").alias("g"), "source")
    peers = groups.select("lid", F.col("gid").alias("h"), F.col("source").alias("item"))
    pair = (pairs.join(F.broadcast(names) if few else names, ["lid", "g"])
            .join(F.broadcast(peers) if few else peers, ["lid", "h"])
            .withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(over)))

    p, q = weight("c", F.col("n") + F.col("v")), weight("lang_c", F.col("lang_n") + F.col("v"))
    term = full.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                       p.alias("p"), q.alias("q")).where("p > q")
    term = (term.withColumn("value", apart(F.col("p"), F.col("q")))
            .withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= top_terms))
    return pair.select(*columns).unionByName(term.select(*columns))


def _pairs(full: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """(lid, g, h, value) for all ordered pairs of groups of a language."""
    spark = groups.sparkSession
    shared = full.select("lid", "term", "gid", "c", "n", "v")
    if not few:  # a broadcast leaves a term's postings together, a shuffle does not
        shared = shared.repartition("lid", "term").sortWithinPartitions("lid", "term")
    shared = shared.mapInArrow(_rows, "lid long, g long, h long, value long")

    zero = groups.select("lid", "gid", "v", weight(F.lit(0), F.col("n") + F.col("v")).alias("p0"))
    peer = zero.select("lid", F.col("gid").alias("h"), F.col("p0").alias("q0"))
    peer = F.broadcast(peer) if few else peer
    base = zero.join(peer, "lid").where("gid <> h").select(
        "lid", F.col("gid").alias("g"), "h",
        F.when(F.col("v") > 0, F.col("v") * apart(F.col("p0"), F.col("q0"))).otherwise(0)
        .cast("long").alias("value"))

    # A group's terms by count: one row per different count.
    hist = full.groupBy("lid", "gid", "c", "n", "v").agg(F.count(F.lit(1)).alias("m"))
    hist = hist.select("lid", "gid", "m", weight("c", F.col("n") + F.col("v")).alias("p"),
                       weight(F.lit(0), F.col("n") + F.col("v")).alias("p0"))
    p, p0, q0, m = (F.col(c) for c in ("p", "p0", "q0", "m"))
    own = hist.join(peer, "lid").where("gid <> h").select("lid", F.explode(F.array(
        F.struct(F.col("gid").alias("g"), F.col("h").alias("h"),
                 (m * (apart(p, q0) - apart(p0, q0))).alias("value")),
        F.struct(F.col("h").alias("g"), F.col("gid").alias("h"),
                 (m * (apart(q0, p) - apart(q0, p0))).alias("value")))).alias("x")).select("lid", "x.*")
    every = base.unionByName(own).unionByName(shared)
    return written(spark, every.groupBy("lid", "g", "h").agg(F.sum("value").alias("value")),
                   "op13-pairs")


def op13_source_audit(spark, sf_dir: str) -> DataFrame:
    """Divergence of all sources of all ``documents``, and the terms behind it."""
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))
