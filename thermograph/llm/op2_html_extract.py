"""Main text of web pages: page structure, and what a host repeats for the rest.

Parsing gives each page's blocks of text in page order, each of one kind:

* *article*: inside ``article`` (or ``main`` on a page without ``article``);
* *marked*: in an element that the page marks as something else (``nav``,
  ``footer``, ``aside``, ``form``..., or by class, id or role);
* *open*: everything else.

Article blocks are the page's main text, whole.  Where a page marks none, its
open blocks are candidates, and what its host repeats decides, by a suffix array
over all tokens of all pages.  A page has two streams: its marked and open blocks,
in page order (equal ones of a host are one, with its number of pages), and its
article.  The streams of a kind are compared with each other: what articles share
isn't a menu, and they stay whole, but the array tells their longest repeat too:

* Suffixes, one for each token, are sharded by host, kind and prefix (the first
  ``run`` tokens).  What tells the shards that several streams reach travels packed.
  A shard that fewer than ``min_pages`` pages reach holds no repeat; in one where the
  same token precedes all suffixes, each repeat is part of a longer one that begins a
  token earlier.  The other shards' suffixes are the array.
* Each shard is sorted by the suffixes' tokens (as 64-bit hashes), to a depth.
  From a suffix on, the longest repeat is the longest prefix that the suffixes
  around it share until they come from ``min_pages`` pages.  Suffixes that still
  agree at the depth are sorted again by what follows, twice as deep.
* The tokens of these longest repeats are boilerplate and go; the unique runs
  stay, in order.

A shard streams by in its order, and only
suffixes that begin a longest repeat travel with their tokens.  Pages are parsed
once, into a written table.

Nulls: a null html is an empty page with an empty text; pages with a null or
malformed url share the host ''.  Equal rows (page_id, url, html) count as one
page and get the same text, one row each.  An empty table gives an empty
result.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.llm._groups import sorted_groups, written
from thermograph.llm._text import U64, Words, mix, text_slices, windows
from thermograph.llm.op3_jaccard_join import BUCKET_KEYS, HELD_KEYS, pack, part_of, unpack

RUN = 8
MIN_PAGES = 2
DEPTH = 64  # tokens that the first sort looks at
HELD = 4096  # rows of a shard held before those with enough neighbours go
BROADCAST = 500_000  # streams

TAG = re.compile(r"""<(?:(!--)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[!?][^>]*>)""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
NAME = re.compile(r"[a-z]+|[0-9]+")
RAW = frozenset({"script", "style", "noscript", "template", "textarea", "iframe", "title"})
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                  "param", "source", "track", "wbr"})
INLINE = frozenset({"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data",
                    "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
                    "ruby", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub",
                    "sup", "time", "tt", "u", "var", "wbr",
                    "math", "mi", "mn", "mo", "mrow", "msub", "msup", "mfrac", "msqrt", "mtext"})
# Elements, and words in class, id or role, that mark what isn't main text.
MARKED = frozenset({"nav", "header", "footer", "aside", "form", "menu", "select", "button",
                    "dialog", "head", "fieldset", "datalist"})
MARKS = frozenset({
    "ad", "ads", "adsense", "advert", "adverts", "advertisement", "advertising", "alert",
    "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo",
    "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination",
    "pager", "popup", "promo", "promotion", "recommended", "related", "replies", "respond",
    "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "toolbar", "widget",
})
OUTSIDE_MARKS = MARKS | {"header", "topbar", "top", "bottom"}
# Words beside them that only say what the marked thing looks like.
SHAPES = frozenset({
    "area", "article", "bar", "block", "body", "box", "buttons", "card", "container", "content",
    "form", "group", "icons", "inner", "item", "links", "list", "main", "outer", "page", "panel",
    "post", "posts", "section", "site", "slot", "thread", "unit", "wrap", "wrapper",
})


def is_marked(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element says that it isn't main text: by its tag, or by a name in
    its class, id or role all of whose words are marks or shapes, one a mark
    (``ad``, ``comment-list``; not ``ad-hoc``)."""
    if tag in MARKED:
        return True
    if not attributes or tag in ("html", "body", "article", "main") and "omment" not in attributes:
        return False
    marks = MARKS if in_article else OUTSIDE_MARKS
    for _, value in ATTRIBUTE.findall(attributes):
        for name in value.strip("\"'").lower().split():
            words = {w for w in NAME.findall(name) if not w.isdigit()}
            if words and not marks.isdisjoint(words) and words <= marks | SHAPES:
                return True
    return False


def blocks(page: str) -> list[tuple[str, str]]:
    """(kind, text) of the page's blocks, in order; kinds "article", "main",
    "marked" and "open".  White space is single and trimmed."""
    out: list[tuple[str, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, str, bool]] = []  # tag, kind of the text inside, raw
    kind = "open"

    def flush() -> None:
        if pieces:
            text = " ".join(html_lib.unescape("".join(pieces)).split())
            if text:
                out.append((kind, text))
            pieces.clear()

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        if m is None:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at:m.start()])
        at = m.end()
        if m[1]:  # a comment
            close = page.find("-->", at)
            at = end if close < 0 else close + 3
            continue
        if not m[3]:  # a declaration
            continue
        tag = m[3].lower()
        if m[2]:
            if tag == "br" or tag == "p" and all(x[0] != "p" for x in stack):
                pieces.append(" ")
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if depth >= 0:
                if tag not in INLINE or stack[depth][1] != (stack[depth - 1][1] if depth else "open"):
                    flush()
                del stack[depth:]
                now = stack[-1][1] if stack else "open"
                if now != kind:
                    flush()
                    kind = now
            elif tag not in INLINE:
                flush()
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}", re.I).search(page, at)
            if not (m[4] or "").rstrip().endswith("/"):
                at = end if close is None else page.find(">", close.end()) + 1 or end
            pieces.append(" " if tag not in ("script", "style", "noscript") else "")
            continue
        if tag not in INLINE:
            if tag == "br":
                pieces.append(" ")
                continue
            flush()
            # A block ends an open paragraph and what is open inside it.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    del stack[i:]
                    kind = stack[-1][1] if stack else "open"
                    break
                if stack[i][0] not in INLINE:
                    break
        if tag in VOID:
            continue
        inner = kind
        if kind != "marked":
            if is_marked(tag, m[4] or "", kind in ("article", "main")):
                inner = "marked"
            elif tag == "article":
                inner = "article"
            elif tag == "main" and kind == "open":
                inner = "main"
        if inner != kind:
            flush()
            kind = inner
        stack.append((tag, inner, False))
    flush()
    return out


def split_page(page: str) -> tuple[str, list[tuple[bool, str]], bool]:
    """(main text, blocks outside it as (open, text), whether the text is still
    to be found among the open blocks)."""
    found = blocks(page)
    for kind in ("article", "main"):
        if any(k == kind for k, _ in found):
            rest = [(False, t) for k, t in found if k != kind]
            return " ".join(t for k, t in found if k == kind), rest, False
    rest = [(k == "open", t) for k, t in found]
    return "", rest, any(o for o, _ in rest)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_id", "url", "_uid", "_host"]
    for batch in batches:
        for i in range(0, len(batch), 256):
            part = batch.slice(i, 256)
            done = [split_page(x or "") for x in part.column("_html").to_pylist()]
            # Of other pages the blocks count as what the host repeats.
            arrays = [part.column(c) for c in names]
            arrays += [pa.array([x[0] for x in done], pa.string()),
                       pa.array([x[2] for x in done]),
                       pa.array([[t for _, t in x[1]] for x in done], pa.list_(pa.string())),
                       pa.array([[o for o, _ in x[1]] for x in done], pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays(
                arrays, [*names, "text", "_open", "_rest", "_is_open"])


def _prefixes(batch: pa.RecordBatch, run: int):
    """(first row, tokens' hashes, words, shard and place of all suffixes of ``run``
    tokens) of slices of streams; a shorter stream has its whole as one."""
    for i, j, texts in text_slices(batch.column("_stream")):
        words = Words(texts)
        h = words.hashes()
        prefix, at = windows(h, words.doc, run)
        short = np.flatnonzero((0 < np.diff(words.first)) & (np.diff(words.first) < run))
        whole = [windows(t, np.zeros(len(t)), len(t))[0] for t in
                 (h[words.first[d]:words.first[d + 1]] for d in short)]
        prefix = np.concatenate((prefix, *whole))
        at = np.concatenate((at, words.first[short])).astype(np.int64)
        host = batch.column("host").slice(i, j - i).to_numpy().view(U64)
        yield i, j, h, words, mix(prefix ^ host[words.doc[at]]), at


def _reached(run: int, buckets: int):
    """The shards that each stream reaches, packed by bucket; twice, with another
    tag, if one stream is enough for a repeat (``alone``)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> Iterator[pa.RecordBatch]:
            if held:
                out = list(zip(*pack(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets),
                               strict=True))
                held.clear()
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()),
                         pa.array(out[2], pa.binary())], ["bucket", "keys", "tags"])

        for batch in batches:
            for i, j, _, words, shard, at in _prefixes(batch, run):
                doc = words.doc[at]
                tag = (batch.column("brief").slice(i, j - i).to_numpy() << 1).astype(np.uint32)[doc]
                alone = batch.column("alone").slice(i, j - i).to_numpy(zero_copy_only=False)[doc]
                held.append((shard, tag))
                held.append((shard[alone], tag[alone] | np.uint32(1)))
                if sum(len(x) for x, _ in held) >= HELD_KEYS:
                    yield from packed()
        yield from packed()
    return rows


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(brief, shard's bucket and low half) of what several tags reach."""
    for rows in sorted_groups(batches, "bucket"):
        every = np.unique(np.concatenate([unpack(a, b) for a, b in zip(
            rows.column("keys").to_pylist(), rows.column("tags").to_pylist(), strict=True)]))
        low = every >> U64(32)
        near = np.zeros(len(low) + 1, bool)
        near[1:-1] = low[1:] == low[:-1]
        every = every[near[1:] | near[:-1]]
        place = (every >> U64(32)).astype(np.int64) | np.int64(rows.column("bucket")[0].as_py() << 32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(((every & U64(0xFFFFFFFF)) >> U64(1)).astype(np.int64)), pa.array(place)],
            ["brief", "place"])


def _suffixes(run: int, buckets: int):
    """(stream, pages, shard, position, token before, whether it is the shard's first
    in the stream) of the suffixes in shards among ``places``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, h, words, shard, at in _prefixes(batch, run):
                part = batch.slice(i, j - i)
                places = part.column("places")
                flat = places.flatten().to_numpy(zero_copy_only=False)
                of = np.repeat(np.arange(j - i), np.diff(places.offsets.to_numpy()))
                place = (part_of(shard, buckets) << U64(32) | shard & U64(0xFFFFFFFF)).view(np.int64)
                doc = words.doc[at]
                # Of whatever stream: what is too much goes with its shard.
                keep = np.isin(mix(place.view(U64)) ^ doc.astype(U64),
                               mix(flat.view(U64)) ^ of.astype(U64))
                at, shard, doc = at[keep], shard[keep], doc[keep]
                position = at - words.first[doc]
                order = np.lexsort((position, shard, doc))
                first = np.ones(len(at), bool)
                first[order[1:]] = (doc[order[1:]] != doc[order[:-1]]) | (
                    shard[order[1:]] != shard[order[:-1]])
                source = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_sid").take(source), part.column("_pages").take(source),
                     pa.array(shard.view(np.int64)), pa.array(position.astype(np.int32)),
                     pa.array(h[at - 1].view(np.int64), mask=position == 0), pa.array(first)],
                    ["_sid", "_pages", "shard", "position", "before", "first"])
    return rows


def _keys(skip: int, depth: int):
    """The starts of each stream with the tokens ``skip`` to ``skip + depth`` of
    their suffixes, as bytes in sorting order, and whether more follow."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("_sid", pa.int64()), ("_pages", pa.int64()), ("position", pa.int32()),
                            ("shard", pa.int64()), ("key", pa.binary()), ("more", pa.bool_())])
        out: list[dict] = []
        size = 0
        for batch in batches:
            for i, j, texts in text_slices(batch.column("_stream")):
                words = Words(texts)
                tokens = words.hashes().astype(">u8").tobytes()
                held = batch.slice(i, j - i).select(["_sid", "_pages", "starts"]).to_pylist()
                for d, row in enumerate(held):
                    end = int(words.first[d + 1])
                    for x in row["starts"]:
                        at = int(words.first[d]) + x["position"] + skip
                        key = tokens[8 * at:8 * min(at + depth, end)]
                        out.append({"_sid": row["_sid"], "_pages": row["_pages"], **x,
                                    "key": key, "more": at + depth < end})
                        size += len(key) + 64
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)
    return rows


def common(a: bytes, b: bytes) -> int:
    """Leading tokens that two keys share."""
    n = min(len(a), len(b)) // 8
    if a[:8 * n] == b[:8 * n]:
        return n
    x, y = np.frombuffer(a, np.uint64, n), np.frombuffer(b, np.uint64, n)
    return int((x != y).argmax())


class Shards:
    """Rows (shard, key, stream, pages, ...) of sorted suffixes, added in order;
    gives each with the length of the longest prefix of its key that suffixes of
    its shard from ``min_pages`` pages share."""

    def __init__(self, min_pages: int, held: int = HELD):
        self.min_pages, self.held = min_pages, held
        self._clear()

    def _clear(self) -> None:
        self.rows: list[tuple] = []
        self.shared: list[int] = []  # tokens that each row shares with the one before
        # How far back the nearest row of another stream is, and the tokens shared with it.
        self.back: list[tuple[int, int]] = []
        self.done = 0

    def add(self, row: tuple) -> Iterator[tuple[tuple, int]]:
        if self.rows and self.rows[-1][0] != row[0]:
            yield from self.finish()
        n = common(self.rows[-1][1], row[1]) if self.rows else -1
        if self.rows and self.rows[-1][2] == row[2]:
            hop, least = self.back[-1]
            self.back.append((hop + 1, min(least, n)))
        else:
            self.back.append((1, n))
        self.shared.append(n)
        self.rows.append(row)
        if len(self.rows) % self.held == 0:
            yield from self._settle(self._streams_before(len(self.rows)))
            # What is left needs only the neighbours before it.
            keep = self._streams_before(self.done)
            self.rows, self.shared, self.back = self.rows[keep:], self.shared[keep:], self.back[keep:]
            self.done -= keep

    def finish(self) -> Iterator[tuple[tuple, int]]:
        yield from self._settle(len(self.rows))
        self._clear()

    def _streams_before(self, end: int) -> int:
        """Where the rows before ``end`` begin that hold ``min_pages`` streams."""
        streams: set = set()
        at = end
        while at and len(streams) < self.min_pages:
            at -= 1
            streams.add(self.rows[at][2])
        return at

    def _settle(self, end: int) -> Iterator[tuple[tuple, int]]:
        last = len(self.rows) - 1
        ahead = [(1, -1)] * (last + 1)
        for i in range(last - 1, self.done - 1, -1):
            n = self.shared[i + 1]
            if self.rows[i][2] == self.rows[i + 1][2]:
                hop, least = ahead[i + 1]
                ahead[i] = (hop + 1, min(least, n))
            else:
                ahead[i] = (1, n)
        for i in range(self.done, end):
            yield self.rows[i], self._longest(i, ahead)
        self.done = max(end, self.done)

    def _longest(self, i: int, ahead: list[tuple[int, int]]) -> int:
        rows, low, high = self.rows, i, i
        length, pages, streams = len(rows[i][1]) // 8, rows[i][3], {rows[i][2]}
        while pages < self.min_pages:
            below = self.back[low][1] if low >= self.back[low][0] else -1
            above = ahead[high][1]
            if max(below, above) < 0:
                return 0
            if below >= above:
                low -= self.back[low][0]
                row, length = rows[low], min(length, below)
            else:
                high += ahead[high][0]
                row, length = rows[high], min(length, above)
            if row[2] not in streams:
                streams.add(row[2])
                pages += row[3]
        return length


def _neighbours(min_pages: int, skip: int, depth: int):
    """The longest repeat from each suffix on; whether it reaches beyond the depth."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[2] for r, _ in found], pa.int64()),
                 pa.array([r[4] for r, _ in found], pa.int32()),
                 pa.array([skip + n for _, n in found], pa.int64()),
                 pa.array([r[5] for r, _ in found], pa.int64()),
                 pa.array([r[6] and n == depth for r, n in found], pa.bool_())],
                ["_sid", "position", "length", "shard", "deeper"])
        shards = Shards(min_pages)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in
                       ("shard", "key", "_sid", "_pages", "position", "next", "more")]
            found = [x for row in zip(*columns, strict=True) for x in shards.add(row)]
            yield batch_of(found)
        yield batch_of(list(shards.finish()))
    return rows


def _of(streams: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """``streams`` with the columns of ``held`` (a written table), by ``key``; only texts
    of streams that have a row there travel, while these are few."""
    ids = held.select(key).distinct()
    if ids.count() <= BROADCAST:
        streams = streams.join(F.broadcast(ids), key, "left_semi")
    return streams.join(held, key)


def longest_repeats(streams: DataFrame, run: int, min_pages: int, depth: int = DEPTH) -> DataFrame:
    """(_sid, position, length) of the longest repeats that begin at a stream's
    tokens, from ``streams`` (_sid, _host, _pages, _stream: of written tables), each
    different within its host, or without repeats asked for inside it.  Repeats that a
    longer one of the same pages contains to its left are left out."""
    spark = streams.sparkSession
    streams = streams.withColumn("brief", F.shiftrightunsigned(F.xxhash64("_sid"), 33))
    size, = streams.agg(F.sum(F.length("_stream"))).first()
    buckets = 1 + (size or 0) // (6 * BUCKET_KEYS)
    # Streams that agree in the bits that travel can't be told apart there.
    twins = streams.groupBy("brief").count().where("count > 1").select("brief", F.lit(True).alias("twin"))
    tagged = streams.join(F.broadcast(twins), "brief", "left").select(
        F.xxhash64("_host").alias("host"), "brief", "_stream",
        (F.col("twin").isNotNull() | (F.col("_pages") >= min_pages)).alias("alone"))
    several = (tagged.mapInArrow(_reached(run, buckets), "bucket int, keys binary, tags binary")
               .repartition(buckets, "bucket").sortWithinPartitions("bucket")
               .mapInArrow(_several, "brief long, place long"))
    places = written(spark, several.groupBy("brief").agg(F.collect_set("place").alias("places")),
                     "op2-places")
    every = written(spark, _of(streams, places, "brief")
                    .select("_sid", "_pages", F.xxhash64("_host").alias("host"), "_stream", "places")
                    .mapInArrow(_suffixes(run, buckets), "_sid long, _pages long, shard long, "
                                "position int, before long, first boolean"), "op2-suffixes")
    shards = (every.groupBy("shard")
              .agg(F.sum(F.when(F.col("first"), F.col("_pages"))).alias("n"),
                   F.min("before").alias("low"), F.max("before").alias("high"),
                   F.max(F.col("before").isNull()).alias("begins"))
              .where((F.col("n") >= min_pages) & (F.col("begins") | (F.col("low") != F.col("high"))))
              .select("shard"))
    active = every.join(shards, "shard", "left_semi").select("_sid", "position", "shard")
    out, skip = None, 0
    while True:
        held = written(spark, active.groupBy("_sid").agg(
            F.collect_set(F.struct("position", "shard")).alias("starts")), "op2-starts")
        array = (_of(streams, held, "_sid").select("_sid", "_pages", "_stream", "starts")
                 .mapInArrow(_keys(skip, depth), "_sid long, _pages long, position int, shard long, "
                             "key binary, more boolean")
                 .withColumn("next", F.xxhash64("shard", "key"))
                 .repartition("shard").sortWithinPartitions("shard", "key", "_sid", "position"))
        found = written(spark, array.mapInArrow(
            _neighbours(min_pages, skip, depth),
            "_sid long, position int, length long, shard long, deeper boolean"), "op2-array")
        ready = found.where("not deeper").select("_sid", "position", "length")
        out = ready if out is None else out.unionByName(ready)
        active = found.where("deeper").select("_sid", "position", "shard")
        if active.isEmpty():
            return out
        skip, depth = skip + depth, 2 * depth


def unique_runs(texts: list[str], is_open: list[bool], repeats: list[dict]) -> tuple[str, int]:
    """The open blocks' tokens outside of the longest repeats (position, length),
    and how many tokens of theirs were inside."""
    sizes = [len(t.split()) for t in texts]
    gone = np.zeros(sum(sizes), bool)
    for r in repeats:
        gone[r["position"]:r["position"] + r["length"]] = True
    out, removed, at = [], 0, 0
    for text, o, n in zip(texts, is_open, sizes, strict=True):
        if o:
            left = [w for w, g in zip(text.split(), gone[at:at + n], strict=True) if not g]
            removed += n - len(left)
            out += left
        at += n
    return " ".join(out), removed


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [unique_runs(t, o, r or []) for t, o, r in zip(
            batch.column("_rest").to_pylist(), batch.column("_is_open").to_pylist(),
            batch.column("repeats").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("url"), pa.array([x[0] for x in done], pa.string()),
             pa.array([x[1] for x in done], pa.int64()), batch.column("longest_repeat")],
            ["_id", "url", "text", "n_repeated", "longest_repeat"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", run: int = RUN, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: ``id_col``, url, text, n_chars, n_repeated (tokens that
    went because the host repeats them), longest_repeat (tokens of the longest run
    outside the article that ``min_pages`` pages of the host have, this one among
    them), article_repeat (likewise of the runs inside the articles)."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("_html"))
    rows = rows.withColumn("_uid", F.xxhash64("_id", "url", "_html")).withColumn(
        "_host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/]+://([^/?#]*)", 1)))
    id_type = rows.schema["_id"].dataType.simpleString()
    url_type = rows.schema["url"].dataType.simpleString()
    schema = (f"_id {id_type}, url {url_type}, _uid long, _host string, text string, _open boolean, "
              "_rest array<string>, _is_open array<boolean>")
    full = written(spark, rows.mapInArrow(_parse, schema), "op2-pages")
    stream = F.concat_ws(" ", "_rest")
    full = full.withColumn("_sid", F.xxhash64("_host", stream))

    own = full.where(F.size("_rest") > 0)
    counts = own.select("_sid", "_uid").distinct().groupBy("_sid").agg(F.count(F.lit(1)).alias("_pages"))
    streams = written(spark, own.groupBy("_sid").agg(
        F.first("_host").alias("_host"), F.first(stream).alias("_stream")).join(counts, "_sid"),
        "op2-streams")
    # A page's article is a stream of its own, compared with the host's other articles.
    full = full.withColumn("_article", F.xxhash64("_uid", F.lit("article")))
    articles = full.where("text <> ''").select(
        F.col("_article").alias("_sid"), F.concat("_host", F.lit("/article")).alias("_host"),
        F.col("text").alias("_stream"), F.lit(1).cast("long").alias("_pages"))
    repeats = longest_repeats(streams.unionByName(articles), run, min_pages)

    # Texts needn't move for the lengths alone while these are few.
    longest = written(spark, repeats.groupBy("_sid").agg(F.max("length").alias("longest_repeat")),
                      "op2-longest")
    longest = F.broadcast(longest) if longest.count() <= BROADCAST else longest
    inside = longest.toDF("_article", "article_repeat")
    clear = full.where("not _open").join(longest, "_sid", "left").join(inside, "_article", "left").select(
        "_id", "url", "text", F.lit(0).cast("long").alias("n_repeated"), "longest_repeat",
        F.coalesce("article_repeat", F.lit(0)).alias("article_repeat"))
    covered = repeats.groupBy("_sid").agg(
        F.collect_list(F.struct("position", "length")).alias("repeats"),
        F.max("length").alias("longest_repeat"))
    rest = (full.where("_open").join(covered, "_sid", "left")
            .select("_id", "url", "_rest", "_is_open", "repeats", "longest_repeat")
            .mapInArrow(_finish, f"_id {id_type}, url {url_type}, text string, n_repeated long, "
                        "longest_repeat long")
            .withColumn("article_repeat", F.lit(0).cast("long")))
    return clear.unionByName(rest).select(
        F.col("_id").alias(id_col), F.col("url").alias(url_col), "text",
        F.length("text").cast("long").alias("n_chars"), "n_repeated",
        F.coalesce("longest_repeat", F.lit(0)).alias("longest_repeat"), "article_repeat")


def op2_html_extract(spark, sf_dir: str) -> DataFrame:
    """Main text of all ``pages``."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
