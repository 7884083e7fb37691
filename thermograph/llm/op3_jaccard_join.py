"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Documents are sets of distinct ``k``-word shingles (64-bit hashes; words are
runs without ASCII white space, A-Z lower-cased).  Two documents link when
``100 * |A & B| >= pct * |A | B|``.

1. *Sets.*  Equal sets become one: copies share a set id, whatever their number.
2. *Size bands and parts.*  Linked sets have sizes within ``pct`` % of each
   other, and differ in at most ``(100 - pct) / (100 + pct) * (|A| + |B|)``
   shingles, say ``d``.  Within a size band the hash space is cut into so many
   parts that every set has shingles in more than ``d`` of them; sets are keyed
   by (band, part, hash of the shingles there).  Of any ``d + 1`` parts with
   shingles linked sets agree on one (pigeonhole), so a set may leave out its
   most frequent keys: no link is lost, and a passage that many documents share
   brings no unrelated ones together.  Sets near a band's lower end are also
   keyed in the band below, where their smaller partners are.  Keys travel packed:
   a task's keys are cut into buckets by their value, a row holds those of a bucket,
   sorted, as differences, with 32 bits of each set's id; a bucket's rows meet in one
   task, which gives the keys that several sets have.  Sets that agree in these bits
   count as one until the tiles.
3. *Tiles.*  Sets that meet by a key are gathered, with all that meet them in
   turn, in tiles of bounded size, and compared there.  What is too large for one
   tile is linked inside blocks, then by what stands for their components; then
   blocks that still meet at a key without being connected are compared.
4. Each comparison bounds the overlap from above by the bit counts of the two
   bitmaps; pairs that pass get an exact intersection of sorted arrays.
5. Components by minimum labels with pointer jumping, written to the shared
   folder after each step.

Nulls: a null text has an empty set.  A document with an empty set links with
nothing.  A row with a null ``doc_id`` shares the component of rows with an
equal set and an id; without such rows its component is null and it links with
nothing (there is no id to fetch its text by).  Repeated ids: each row is returned; rows of one id share its component (the
smallest of theirs).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermograph.llm._groups import components, sorted_groups, without_ids, written
from thermograph.llm._text import U64, Words, mix, shingle_sets, text_slices

# Parts of the hash space, in largest differences of the band.  The lowest level
# at which every set of a band holds is taken for the whole band.  More parts are
# more keys, and more of them that a set may leave out: with few, most sets have to
# look at keys of frequent words, and in a large corpus these connect everything.
LEVELS = (1.7, 2.5, 4.0)
SMALL = 8  # in bands below, each shingle is a part: few keys, and frequent ones count more
HELD_KEYS = 1 << 22  # keys that a task gathers before it packs them
BUCKET_KEYS = 1 << 19  # keys of a bucket, about
BLOCK = 512  # members of a tile that are compared in one task
BLOCK_SHINGLES = 1 << 21  # and their shingles, unless one set has more
# Rows up to which (document, tile) is broadcast to the texts at once, and how often;
# beyond, a join shuffles all texts.
BROADCAST_ROWS = 500_000
BROADCASTS = 8


def max_difference(n, pct: int):
    """Most shingles by which a set of ``n`` and a linked one that isn't
    smaller differ: sizes a <= b <= a * 100 / pct, overlap >= pct * (a + b) /
    (100 + pct)."""
    return (100 - pct) * (n + n * 100 // pct) // (100 + pct)


def band_of(n: np.ndarray) -> np.ndarray:
    """Sizes 2**b .. 2**(b + 1) - 1 are band b."""
    return np.frexp(n.astype(np.float64))[1] - 1


def band_parts(band: int, level: int, pct: int) -> int:
    """Parts of the hash space in ``band`` at ``level``: the largest difference
    there, with an allowance for empty parts that grows with the level."""
    return int(max_difference(2 << band, pct) * LEVELS[level]) + 2


def part_of(value: np.ndarray, parts: int) -> np.ndarray:
    return ((value >> U64(32)) * U64(parts)) >> U64(32)


def set_ids(row: np.ndarray, value: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, id) of each row's set; ids are even."""
    size = np.bincount(row, minlength=n_rows)
    sid = np.zeros(n_rows, U64)
    full = np.flatnonzero(size)
    if len(full):
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))[full]
        sid[full] = mix(np.add.reduceat(mix(value ^ U64(0x5851F42D4C957F2D)), begin)
                        ^ size[full].astype(U64) * U64(0x9E3779B97F4A7C15)) & ~U64(1)
    return size, sid


def _by_band(row: np.ndarray, value: np.ndarray, size: np.ndarray, band: np.ndarray):
    """(band, elements' rows, elements' values) for the rows with a band >= 0."""
    of = band[row]
    for b in np.unique(band[band >= 0]):
        at = np.flatnonzero(of == b)
        yield int(b), row[at], value[at]


def _changes(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def bands_of(size: np.ndarray, pct: int) -> tuple[np.ndarray, np.ndarray]:
    """The band of each size and, if smaller partners may be in the one below, that
    one; else -1."""
    own = np.where(size > 0, band_of(np.maximum(size, 1)), -1)
    least = -(-size * pct // 100)
    return own, np.where((size > 0) & (band_of(np.maximum(least, 1)) < own), own - 1, -1)


def parts_by_level(row, value, size, pct: int, below: bool = False) -> np.ndarray:
    """Per row and level, in how many parts of its own band (or the one below) its
    set has shingles; at the last level each shingle is a part."""
    band = bands_of(size, pct)[int(below)]
    out = np.zeros((len(size), len(LEVELS) + 1), np.int32)
    out[:, -1] = size
    for b, r, v in _by_band(row, value, size, band):
        for k in range(len(LEVELS)):
            out[:, k] += np.bincount(r[_changes(r, part_of(v, band_parts(b, k, pct)))],
                                     minlength=len(size)).astype(np.int32)
    return out


def set_keys(row, value, size, sid, pct: int, level: dict[int, int]):
    """(key, tag) of sets, in their own band (tag: id + 1) and, if a smaller
    partner may be in the band below, in that one too (tag: id)."""
    own, below = bands_of(size, pct)
    for mark, band in ((U64(1), own), (U64(0), below)):
        for b, r, v in _by_band(row, value, size, band):
            k = level.get(b)
            if k is None:  # no set in this band: nobody to meet there
                continue
            if k == len(LEVELS):
                part, begin, total = v, np.arange(len(v)), mix(v)
            else:
                part = part_of(v, band_parts(b, k, pct))
                begin = _changes(r, part)
                total = np.add.reduceat(mix(v), begin)
            tag = U64((b + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            yield mix(total ^ mix(part[begin] + tag)), sid[r[begin]] | mark


def bitmaps(row: np.ndarray, value: np.ndarray, n_rows: int, words: int) -> np.ndarray:
    """Parity bitmaps of ``64 * words`` bits: each shingle flips one bit, so two
    bitmaps differ in at most as many bits as the sets differ in shingles."""
    bit = (mix(value) >> U64(32)) % U64(64 * words)
    out = np.zeros((n_rows, words), U64)
    np.bitwise_xor.at(out, (row, (bit >> U64(6)).astype(np.int64)), U64(1) << (bit & U64(63)))
    return out


def bitmap_words(n: int) -> int:
    """64-bit words of the bitmaps of sizes near ``n``: wider for larger bands."""
    return 4 if n < 256 else 8 if n < 1024 else 32



def linked(a: np.ndarray, b: np.ndarray, pct: int) -> bool:
    """Exact test on two sorted arrays of distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= pct * (len(a) + len(b) - common)


class Forest:
    """Union-find over 0 .. n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def link_tile(sets: list[np.ndarray], side: np.ndarray | None, pct: int,
              forest: Forest | None = None) -> Forest:
    """Connect all linked sets of a tile (only pairs across ``side`` if given).

    Sizes and the bit counts of the bitmaps bound each overlap from above; what
    passes is intersected exactly, unless it is connected already."""
    n = np.array([len(x) for x in sets])
    forest = forest or Forest(len(sets))
    by_size = np.argsort(n, kind="stable")
    width = bitmap_words(int(n.max()))
    row = np.repeat(np.arange(len(sets)), n)
    bits = bitmaps(row, np.concatenate(sets), len(sets), width)
    for k in range(1, len(by_size)):
        x = by_size[k]
        rest = by_size[np.searchsorted(n[by_size], -(-pct * n[x] // 100)):k]
        if side is not None:
            rest = rest[side[rest] != side[x]]
        if not len(rest):
            continue
        apart = np.bitwise_count(bits[rest] ^ bits[x]).sum(axis=1, dtype=np.int64)
        most = (n[rest] + n[x] - apart) // 2
        for y in rest[100 * most >= pct * (n[rest] + n[x] - most)].tolist():
            if forest.root(y) != forest.root(int(x)) and linked(sets[y], sets[x], pct):
                forest.join(y, int(x))
    return forest


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _features(column: str, k: int, pct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in text_slices(batch.column(column)):
                row, value = shingle_sets(Words(texts, lower=True), j - i, k)
                size, sid = set_ids(row, value, j - i)
                parts = [parts_by_level(row, value, size, pct, below) for below in (False, True)]
                flat = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(
                    pa.list_(pa.int32())) for x in parts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(i, j - i), pa.array(size.astype(np.int64)),
                     _signed(sid), *flat], ["_id", "n", "sid", "parts", "below"])
    return run


def pack(key: np.ndarray, tag: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, keys, tags) for the buckets that ``key`` reaches: the low halves of the
    keys, sorted, as differences with their bytes by place (the high ones are mostly
    zero), and the tags in that order."""
    place = part_of(key, buckets) << U64(32) | key & U64(0xFFFFFFFF)
    order = np.argsort(place)
    place, tag = place[order], tag[order]
    bucket = (place >> U64(32)).astype(np.int64)
    begin = _changes(bucket).tolist()
    low = place.astype(np.uint32)
    for i, j in zip(begin, [*begin[1:], len(low)], strict=True):
        step = np.diff(low[i:j], prepend=np.uint32(0))
        yield int(bucket[i]), step.view(np.uint8).reshape(-1, 4).T.tobytes(), tag[i:j].tobytes()


def unpack(keys: bytes, tags: bytes) -> np.ndarray:
    """``key << 32 | tag`` of a row of :func:`pack`."""
    step = np.ascontiguousarray(np.frombuffer(keys, np.uint8).reshape(4, -1).T).view(np.uint32)
    low = np.cumsum(step.ravel(), dtype=np.uint32)
    return low.astype(U64) << U64(32) | np.frombuffer(tags, np.uint32)


def _keys(column: str, k: int, pct: int, level: dict[int, int], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of this task: copies of a set bring no more keys
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size_held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            if held:
                rows = list(zip(*pack(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets),
                                strict=True))
                held.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()),
                     pa.array(rows[2], pa.binary())], ["bucket", "keys", "tags"])

        for batch in batches:
            for i, j, texts in text_slices(batch.column(column)):
                row, value = shingle_sets(Words(texts, lower=True), j - i, k)
                size, sid = set_ids(row, value, j - i)
                new = np.zeros(j - i, bool)
                for at, s in enumerate(sid.tolist()):
                    if size[at] and s not in seen:
                        seen.add(s)
                        new[at] = True
                keep = new[row]
                for key, of in set_keys(row[keep], value[keep], np.where(new, size, 0), sid,
                                        pct, level):
                    # 31 bits of the id, and the mark.
                    held.append((key, (of >> U64(33) << U64(1) | of & U64(1)).astype(np.uint32)))
                    size_held += len(key)
                if size_held >= HELD_KEYS:
                    yield from packed()
                    size_held = 0
        yield from packed()
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys that several sets have: a row (key, brief, m, own) for each of the
    ``m`` sets."""
    for rows in sorted_groups(batches, "bucket"):
        bucket = rows.column("bucket")[0].as_py()
        every = np.unique(np.concatenate([unpack(a, b) for a, b in zip(
            rows.column("keys").to_pylist(), rows.column("tags").to_pylist(), strict=True)]))
        low, tag = every >> U64(32), every & U64(0xFFFFFFFF)
        brief = (tag >> U64(1)).astype(np.int64)
        begin = _changes(low)
        size = np.diff(begin, append=len(low))
        several = np.repeat(brief[begin] != brief[begin + size - 1], size)
        key = low.astype(np.int64) | np.int64(bucket << 32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[several]) for x in (key, brief, np.repeat(size, size).astype(np.int32),
                                            tag & U64(1) == U64(1))],
            ["key", "brief", "m", "own"])


def _tiles(column: str, k: int, pct: int, sided: bool):
    """Links of each tile as (sid, root): every member with the tile's member
    that stands for its component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in sorted_groups(batches, "tile"):
            sets: list[np.ndarray] = []
            for i, j, texts in text_slices(tile.column(column)):
                row, value = shingle_sets(Words(texts, lower=True), j - i, k)
                sets += np.split(value, np.cumsum(np.bincount(row, minlength=j - i))[:-1])
            sid = tile.column("sid").to_numpy()
            # A repeated doc_id may bring other texts, and a set may come twice.
            own = {}
            for at, s in enumerate(sid.tolist()):
                size, found = set_ids(np.zeros(len(sets[at]), np.int64), sets[at], 1)
                if size[0] and found.view(np.int64)[0] == s:
                    own[s] = at
            at = np.array(sorted(own.values()), np.int64)
            if len(at) < 2:
                continue
            side = tile.column("block").to_numpy()[at] if sided else None
            forest = link_tile([sets[x] for x in at], side, pct)
            root = np.array([forest.root(x) for x in range(len(at))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(sid[at]), pa.array(sid[at][root])], ["sid", "root"])
    return run


def _verify(docs: DataFrame, tiles: DataFrame, column: str, k: int, pct: int,
            sided: bool) -> DataFrame:
    """Links inside ``tiles`` (tile, block, sid, _id) from the texts."""
    # Texts of documents in tiles alone travel: tiles are broadcast, in turns if many.
    turns = -(-tiles.count() // BROADCAST_ROWS) if BROADCAST_ROWS else BROADCASTS + 1
    if turns <= BROADCASTS:
        turn = F.pmod(F.xxhash64("_id"), F.lit(max(turns, 1)))
        rows = reduce(DataFrame.unionByName, (
            docs.join(F.broadcast(tiles.where(turn == x)), "_id") for x in range(max(turns, 1))))
    else:
        rows = docs.join(tiles, "_id")
    rows = (rows.select("tile", "block", "sid", column)
            .repartition("tile").sortWithinPartitions("tile"))
    return rows.mapInArrow(_tiles(column, k, pct, sided), "sid long, root long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = 5, pct: int = 80) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id, n_copies (rows
    with an equal set, itself included; 0 if empty)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = docs.schema["_id"].dataType.simpleString()
    features = written(spark, docs.mapInArrow(
        _features("_text", k, pct), f"_id {id_type}, n long, sid long, parts array<int>, "
        "below array<int>"),
        "op3-features")
    full = features.where("n > 0").withColumn("band", F.floor(F.log2(F.col("n") + 0.5)).cast("int"))
    differ = F.floor((100 - pct) * (F.col("n") + F.floor(F.col("n") * 100 / pct)) / (100 + pct))
    # One row per band: the lowest level at which all its sets hold, that is, have
    # more parts than shingles that may differ.
    holds = F.array(*[(F.get("parts", F.lit(x)) > differ).cast("int")
                      for x in range(len(LEVELS) + 1)])
    bands = full.groupBy("band").agg(
        *[F.min(holds[x]).alias(f"h{x}") for x in range(len(LEVELS) + 1)],
        *[F.sum(F.get("parts", F.lit(x))).alias(f"s{x}") for x in range(len(LEVELS) + 1)]).collect()
    level = {r["band"]: next(x for x in range(len(LEVELS) + 1) if r[f"h{x}"])
             if r["band"] >= SMALL else len(LEVELS) for r in bands}
    buckets = 1 + sum(r[f"s{level[r['band']]}"] for r in bands) * 4 // 3 // BUCKET_KEYS
    at = under = F.lit(0)
    for b, x in level.items():
        at = F.when(F.col("band") == b, x).otherwise(at)
        under = F.when(F.col("band") == b + 1, x).otherwise(under)
    # spare: how many of a set's parts need not be looked at, in either band.
    sets = written(spark, full.groupBy("sid").agg(
        F.min("_id").alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("n_copies"),
        F.max(F.get("parts", at) - differ - 1).alias("spare"),
        F.max(F.get("below", under) - differ - 1).alias("spare_below"),
        F.shiftrightunsigned("sid", 33).alias("brief")), "op3-sets")

    packed = docs.mapInArrow(_keys("_text", k, pct, level, buckets),
                             "bucket int, keys binary, tags binary")
    multi = (packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_shared, "key long, brief long, m int, own boolean"))
    # Linked sets agree on more than ``spare`` keys of either one: a set with fewer that
    # any other set has links with nothing in that band.  The others, as the smaller of
    # a pair, look at their least frequent keys only.
    briefs = sets.groupBy("brief").agg(F.min("spare").alias("spare"), F.min("spare_below").alias(
        "spare_below"), F.count(F.lit(1)).alias("twins"))
    side = Window.partitionBy("brief", "own")
    multi = (multi.join(briefs, "brief")
             .withColumn("left", F.count(F.lit(1)).over(side)
                         - F.when(F.col("own"), F.col("spare")).otherwise(F.col("spare_below")))
             .where("left > 0")
             .withColumn("r", F.row_number().over(side.orderBy("m", "key"))))
    multi = written(spark, multi.select("key", "brief", F.expr("own and r <= left").alias("looks")),
                    "op3-keys")
    meet = multi.join(multi.where("looks").select("key").distinct(), "key", "left_semi")
    meet = meet.withColumn("lead", F.min("brief").over(Window.partitionBy("key")))
    meet = written(spark, meet.where("brief <> lead").select("key", "brief", "lead"), "op3-meet")
    near = components(spark, meet.select(F.col("lead").alias("a"), F.col("brief").alias("b")),
                      "op3-near").withColumnRenamed("node", "brief")
    twins = briefs.where("twins > 1").join(near, "brief", "left_anti")
    near = near.unionByName(twins.select("brief", F.col("brief").alias("label")))

    # Tiles: what may be linked, in blocks of bounded size.
    members = written(spark, near.join(sets.select("sid", "brief", "first", "n"), "brief"),
                      "op3-members")
    big = members.groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    big = big.select("label", F.ceil(F.greatest(
        F.col("m") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = written(spark, members.join(big, "label").withColumn(
        "block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")), "op3-blocks")
    tiles = members.select(F.xxhash64("label", "block").alias("tile"), "block", "sid",
                           F.col("first").alias("_id"))
    links = written(spark, _verify(docs, tiles, "_text", k, pct, False), "op3-links")

    split = members.where("blocks > 1")
    if not split.isEmpty():
        links = _across(docs, members, meet, links, k, pct)
    label = links.groupBy("sid").agg(F.min("root").alias("label"))
    found = sets.join(label, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    parts = found.groupBy("label").agg(F.min("first").alias("component_id"))
    named = found.join(parts, "label").select("sid", "component_id", "n_copies")
    out = features.join(named, "sid", "left")
    return out.select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
        F.coalesce("n_copies", F.lit(0)).cast("long").alias("n_copies"))


def _across(docs: DataFrame, members: DataFrame, meet: DataFrame, links: DataFrame,
            k: int, pct: int) -> DataFrame:
    """Links between blocks of the components that are too large for one tile.

    First the members that stand for the blocks' components are linked among
    themselves, in tiles again, until that connects nothing more.  Then, for
    each key whose sets aren't all connected yet, the blocks that meet there
    are compared pair by pair."""
    spark = docs.sparkSession
    split = members.where("blocks > 1")
    inner = links.join(split.select("sid"), "sid", "left_semi")
    edges = inner.where("sid <> root").select(F.col("sid").alias("a"), F.col("root").alias("b"))
    heads = split.join(inner.where("sid <> root").select("sid"), "sid", "left_anti")
    heads = written(spark, heads, "op3-heads")
    count = heads.count()
    while count:
        size = heads.groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t"))
        size = size.select("label", F.ceil(F.greatest(
            F.col("m") / BLOCK, F.col("t") / BLOCK_SHINGLES)).alias("parts"))
        # Another seed each time, so that other heads meet.
        tiles = heads.join(size, "label").select(
            F.xxhash64("label", F.pmod(F.xxhash64("sid", F.lit(count)), "parts")).alias("tile"),
            "block", "sid", F.col("first").alias("_id"))
        more = written(spark, _verify(docs, tiles, "_text", k, pct, False)
                       .where("sid <> root"), "op3-heads-links")
        edges = edges.unionByName(more.select(F.col("sid").alias("a"), F.col("root").alias("b")))
        heads = written(spark, heads.join(more.select("sid").distinct(), "sid", "left_anti"),
                        "op3-heads")
        before, count = count, heads.count()
        if count > 0.7 * before:
            break
    if not edges.isEmpty():
        done = components(spark, edges, "op3-done").withColumnRenamed("label", "now")
    else:
        done = spark.createDataFrame([], "node long, now long")
    state = split.join(done.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", "brief", "label", "block", "first", F.coalesce("now", "sid").alias("now"))
    state = written(spark, state, "op3-state")
    at = meet.select("key", "brief").unionByName(
        meet.select("key", F.col("lead").alias("brief"))).distinct().join(state, "brief")
    open_keys = at.groupBy("key").agg(F.min("now").alias("lo"), F.max("now").alias("hi"),
                                      F.min("block").alias("b0"), F.max("block").alias("b1"))
    open_keys = open_keys.where("lo <> hi and b0 <> b1").select("key")
    left = written(spark, at.join(open_keys, "key", "left_semi"), "op3-open")
    if left.isEmpty():
        rest = None
    else:
        blocks = left.groupBy("key").agg(F.sort_array(F.collect_set("block")).alias("bs"),
                                         F.first("label").alias("label"))
        pairs = blocks.select("label", F.explode("bs").alias("i"), "bs").select(
            "label", "i", F.explode(F.filter("bs", lambda x: x > F.col("i"))).alias("j")).distinct()
        ends = pairs.select("label", "i", "j", F.explode(F.array("i", "j")).alias("block"))
        who = left.select("sid", "label", "block", F.col("first").alias("_id")).distinct()
        tiles = who.join(ends, ["label", "block"]).select(
            F.xxhash64("label", "i", "j").alias("tile"), "block", "sid", "_id")
        rest = written(spark, _verify(docs, tiles, "_text", k, pct, True)
                       .where("sid <> root"), "op3-rest")
    if rest is not None and not rest.isEmpty():
        edges = edges.unionByName(rest.select(F.col("sid").alias("a"), F.col("root").alias("b")))
        done = components(spark, edges, "op3-final").withColumnRenamed("label", "now")
    far = done.select(F.col("node").alias("sid"), F.col("now").alias("root"))
    near = links.join(split.select("sid"), "sid", "left_anti")
    return written(spark, near.unionByName(far), "op3-all")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                pct: int = 80) -> DataFrame:
    """``docs`` without all but the first (lowest id) of each component.  An id
    that several rows repeat goes only if no row of it stands for a component."""
    near = jaccard_components(docs, id_col, text_col, k, pct)
    stands = F.max((F.col(id_col) == F.col("component_id")).cast("int"))
    out = near.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(stands.alias("s"))
    out = written(docs.sparkSession, out.where("s = 0").select(id_col), "op3-out")
    return without_ids(docs, out, id_col)


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of near duplicates of all ``documents``: doc_id, n_shingles,
    component_id, n_copies."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
