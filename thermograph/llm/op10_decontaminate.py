"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Words are runs without ASCII white space, lower-cased.  An overlap counts if
``PCT`` % or more of ``WINDOW`` consecutive words (all words of a shorter item)
are equal; items of fewer than ``SHORTEST`` words count where all their words
are.  A seed is what a fixed mask leaves of the words from a position on: the
words at the mask's places, the others are ignored.  The two masks are chosen so
that wherever an overlap's words are replaced, as many as it allows, one of them
finds a place with equal words only: proved by going through all placements for
all widths (``fewest_hits``; a test holds it).  No overlap is without a seed.

1. Every position of every benchmark item and every document gives the hash of
   its seed under each mask.  The hashes are joined; a match of item position
   ``i`` and document position ``p`` is a hit on diagonal ``p - i``.  Short items
   have one hash, of all their words.  The benchmark's hashes are broadcast if
   there are at most ``BROADCAST_SEEDS`` of them; otherwise the join shuffles hashes.
2. Hits are counted by (document, item, diagonal); those with fewer hits than an
   overlap of the item's width leaves at least go.
3. The texts of the documents found (a semi-join, by broadcast of their ids up to
   ``BROADCAST_IDS``) are laid over the items on the diagonals, and the equal words
   of each window are counted.

Nulls and short texts: a null or empty text has no words and never overlaps.  A null
item id is an item of its own; a null document id is matched as null.  Rows that
repeat an id count as one document (or item): any of them may hold the overlap.  An
empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermograph.llm._groups import without_ids, written

# Places that a mask looks at; the words between are ignored.
MASKS = ((0, 1, 2, 4), (0, 1, 4, 5))
SHORTEST = 9
WINDOW = 20
PCT = 80
BROADCAST_SEEDS = 1_000_000
BROADCAST_IDS = 500_000

_SPACE = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Lower-cased words; an empty array for a null or blank text."""
    bare = F.lower(F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE)))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, "[ \\t\\n\\x0b\\f\\r]+"))


@cache
def fewest_hits(width: int) -> int:
    """Seeds that an overlap of ``width`` words leaves at least, over all placements
    of the most words that may differ."""
    differ = width * (100 - PCT) // 100
    seeds = [{at + o for o in mask} for mask in MASKS for at in range(width - mask[-1])]
    return min(sum(not seed & set(gone) for seed in seeds)
               for gone in combinations(range(width), differ))


def seeds(df: DataFrame, id_name: str, short: list[int]) -> DataFrame:
    """(id, n, position, key): the hashes at each position of ``df`` (id, text): of
    the seed of each mask, and of the next words for each number in ``short``;
    ``n``: words of the text."""
    span = max([1, *short, *[mask[-1] + 1 for mask in MASKS]])
    hashed = df.select(id_name, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    n = F.size("h")
    shifted = [F.slice("h", o + 1, F.greatest(n, F.lit(1))).alias(f"w{o}") for o in range(span)]
    rows = hashed.where(n > 0).select(id_name, n.alias("n"), F.posexplode(F.arrays_zip(*shifted)))
    looks = [*MASKS, *[tuple(range(k)) for k in short]]
    # A null hash is a place behind the last word; the last place is the farthest.
    keys = [F.when(F.col(f"col.w{look[-1]}").isNotNull(), F.xxhash64(
        F.lit(k), *[F.col(f"col.w{o}") for o in look])) for k, look in enumerate(looks)]
    rows = rows.select(id_name, "n", F.col("pos").cast("int").alias("position"),
                       F.posexplode(F.array(*keys)).alias("look", "key"))
    return rows.where("key is not null")


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (doc, item, diagonal) with as many seed matches as an overlap has."""
    length = items.select(F.size(words(F.col("text"))).alias("n")).where(f"n > 0 and n < {SHORTEST}")
    short = sorted(r.n for r in length.distinct().collect())  # SHORTEST - 1 numbers at most
    least = F.array(*[F.lit(fewest_hits(w)) for w in range(SHORTEST, WINDOW + 1)])
    each = seeds(items, "item", short)
    # A short item is found by its whole length only, a longer one by the masks.
    number = F.array(*[F.lit(k) for k in short]) if short else F.array().cast("array<int>")
    whole = F.get(number, F.col("look") - len(MASKS))
    each = each.where(((F.col("n") >= SHORTEST) & (F.col("look") < len(MASKS)))
                      | ((F.col("n") < SHORTEST) & (whole == F.col("n"))))
    each = each.select("item", F.col("position").alias("i"), "key", F.when(
        F.col("n") < SHORTEST, 1).otherwise(
        F.get(least, F.least("n", F.lit(WINDOW)) - SHORTEST)).alias("least"))
    theirs = seeds(docs, "doc", short).select("doc", "position", "key")
    if each.count() <= BROADCAST_SEEDS:
        # One pass over the documents' positions, with a map-side look-up.
        side = each.groupBy("key").agg(F.collect_list(F.struct("item", "i", "least")).alias("at"))
        found = theirs.join(F.broadcast(side), "key").select("doc", "position", F.explode("at").alias("at"))
        found = found.select("doc", "at.item", (F.col("position") - F.col("at.i")).alias("diagonal"),
                             "at.least")
    else:
        found = theirs.join(each, "key").select(
            "doc", "item", (F.col("position") - F.col("i")).alias("diagonal"), "least")
    # Rows that repeat an id add up, so none of them has too few.
    counted = found.groupBy("doc", "item", "diagonal").agg(
        F.count(F.lit(1)).alias("n_hits"), F.min("least").alias("least"))
    return counted.where("n_hits >= least").select("doc", "item", "diagonal")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id",
             item_text: str = "text") -> DataFrame:
    """One row per document and item that overlap: ``id_col``, ``item_col``,
    n_words (of the item), n_equal (words equal on the best diagonal), best
    (equal words in the best window) and diagonal (of several as good, the
    smallest)."""
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    found = written(docs.sparkSession, hits(docs, items), "op10-hits")
    ids = found.select(F.col("doc").alias("hit")).distinct()
    few = ids.count() <= BROADCAST_IDS
    docs = docs.join(F.broadcast(ids) if few else ids,
                     F.col("doc").eqNullSafe(F.col("hit")), "left_semi")
    ours = items.select(F.col("item").alias("own"), words(F.col("text")).alias("b"))
    texts = docs.select(F.col("doc").alias("of"), F.col("text"))
    both = found.join(texts, F.col("doc").eqNullSafe(F.col("of"))).select(
        "doc", "item", "diagonal", words(F.col("text")).alias("a"))
    both = both.join(ours, F.col("item").eqNullSafe(F.col("own")))
    laid = both.select("doc", "item", "diagonal", F.size("b").alias("n_words"), F.transform(
        "b", lambda w, i: (w.eqNullSafe(F.get(F.col("a"), i + F.col("diagonal")))).cast("int"))
        .alias("equal"))
    width = F.least(F.lit(WINDOW), F.col("n_words"))
    sums = F.transform(F.sequence(F.lit(1), F.col("n_words") - width + 1), lambda at: F.aggregate(
        F.slice("equal", at, width), F.lit(0), lambda s, x: s + x))
    scored = laid.select(
        "doc", "item", "diagonal", "n_words", width.alias("width"),
        F.aggregate("equal", F.lit(0), lambda s, x: s + x).alias("n_equal"),
        F.array_max(sums).alias("best"))
    needed = F.when(F.col("n_words") < SHORTEST, 100).otherwise(PCT) * F.col("width")
    good = scored.where(100 * F.col("best") >= needed)
    top = good.groupBy("doc", "item").agg(F.max(F.struct(
        "best", "n_equal", (-F.col("diagonal")).alias("back"), "n_words")).alias("t"))
    return top.select(F.col("doc").alias(id_col), F.col("item").alias(item_col),
                      F.col("t.n_words").cast("long").alias("n_words"),
                      F.col("t.n_equal").cast("long").alias("n_equal"),
                      F.col("t.best").cast("long").alias("best"),
                      (-F.col("t.back")).cast("long").alias("diagonal"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap with an item.  Rows with a
    null id are judged together, as one document."""
    bad = overlaps(docs, benchmark, id_col, text_col).select(id_col).distinct()
    return without_ids(docs, written(docs.sparkSession, bad, "op10-out"), id_col)


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Overlaps of all ``documents`` with all ``benchmark`` items."""
    return overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                    spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
