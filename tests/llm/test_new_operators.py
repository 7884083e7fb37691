"""Operators 11 to 13 against brute force, and on rows that are odd in some way."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.odd_tables import frame, odd_rows, prose  # noqa: F401
from thermograph.llm import (op11_minhash_dedup as op11, op12_spelling_variants as op12,
                             op13_source_audit as op13)

SPACE = re.compile(r"[\x20\x09-\x0d]+")
LOWER = str.maketrans(op12.UPPER, op12.LOWER)


# --- 11: near duplicates

def shingles(text: str | None, k: int = 4) -> frozenset:
    words = [w for w in SPACE.split((text or "").translate(LOWER)) if w]
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute_components(rows) -> list[tuple]:
    """(id, size, component, kept) by comparing everything with everything."""
    sets = [shingles(t) for _, t, *_ in rows]
    comp = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            same = a == sets[j] and a
            both = rows[i][0] is not None and rows[j][0] is not None
            if same or (both and a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j])):
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    out = []
    for (i, *_), s, c in zip(rows, sets, comp, strict=True):
        ids = [r[0] for r, d in zip(rows, comp, strict=True) if d == c and r[0] is not None]
        least = (min(ids) if ids else None) if s else i
        out.append((i, len(s), least, i == least if None not in (i, least) else least is None))
    return sorted(out, key=repr)


def near_copies(rng: random.Random, text: str, n: int, edits: int) -> list[str]:
    out = []
    for _ in range(n):
        words = text.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        out.append(" ".join(words))
    return out


def check_components(spark, rows):
    got = [tuple(r) for r in op11.minhash_components(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == brute_components(rows)


def test_minhash_odd_rows(spark, odd_rows):
    rng = random.Random(5)
    rows = [*odd_rows, (20, "One  two\tTHREE"), (21, "one two three four"), (22, "One two three Four"),
            *[(30 + i, t) for i, t in enumerate(near_copies(rng, odd_rows[0][1], 12, 6))]]
    check_components(spark, rows)
    assert op11.minhash_components(frame(spark, [])).count() == 0


@pytest.mark.parametrize("bucket, block, edges", [(3, 6, 0), (8, 4, 1 << 19)])
def test_minhash_large_components(spark, monkeypatch, bucket, block, edges):
    """Components beyond a tile, keys beyond a bucket and many edges lose no link."""
    monkeypatch.setattr(op11, "EDGES", edges)
    monkeypatch.setattr(op11, "BUCKET", bucket)
    monkeypatch.setattr(op11, "BLOCK", block)
    rng = random.Random(bucket)
    rows = []
    for n, edits in ((60, 9), (40, 4), (25, 14)):
        rows += [(1000 - len(rows) - i, t)
                 for i, t in enumerate(near_copies(rng, prose(rng, 90), n, edits))]
    check_components(spark, rows)


def test_distance_holds_what_links():
    """Of sets at a similarity of 0.8 none is beyond the signatures' distance."""
    rng = np.random.default_rng(1)
    value = rng.integers(0, 1 << 63, 2000 * 90).astype(np.uint64).reshape(2000, 90)
    a, b = value[:, :80 + 0], np.concatenate((value[:, :72], value[:, 80:]), axis=1)
    row = np.repeat(np.arange(2000), 80)
    sa = op11.signatures(row, a.ravel(), 2000)
    row = np.repeat(np.arange(2000), 82)
    sb = op11.signatures(row, b.ravel(), 2000)
    apart = (sa != sb).sum(axis=1)
    assert apart.max() <= op11.DISTANCE and abs(apart.mean() - 48 * 0.2) < 0.3


@pytest.mark.parametrize("chunks, n", [(op11.CHUNKS, 48), (op11.LONGER, 336)])
def test_pairs_under_the_distance_share_a_key(chunks, n):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 16, (500, op11.POSITIONS)).astype(np.uint16)
    b = a.copy()
    for r in b:
        r[rng.permutation(op11.POSITIONS)[:op11.DISTANCE]] += 1
    same = [x == y for x, y in zip(op11.chunk_keys(a, chunks), op11.chunk_keys(b, chunks), strict=True)]
    assert len(same) == n and np.any(same, axis=0).all()
    first = op11.first_common(a == b, chunks)
    assert first.tolist() == np.argmax(np.array(same), axis=0).tolist()
    assert op11.first_common(a != a, chunks).tolist() == [-1] * 500


def test_runs_of_keys_over_batches():
    import pyarrow as pa
    rng = random.Random(3)
    keys = sorted(rng.choice([1, 1, 1, 2, *range(3, 40)]) for _ in range(200))
    rows = [(k, 0, i) for i, k in enumerate(keys)]
    count = Counter(keys)
    want = [(k, i, keys.index(k) if count[k] > 6 else None) for k, _, i in rows if count[k] > 1]
    for step in (1, 7, 200):
        batches = [pa.RecordBatch.from_pydict({"key": [r[0] for r in rows[i:i + step]], "nth": pa.array(
            [0] * len(rows[i:i + step]), pa.int32()), "sid": [r[2] for r in rows[i:i + step]]})
            for i in range(0, 200, step)]
        got = [(r["key"], r["sid"], r["lead"]) for b in op11._runs(6)(iter(batches)) for r in b.to_pylist()]
        assert got == want


# --- 12: spelling variants

def brute_variants(rows) -> list[tuple]:
    n = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)):] == b[i + 1:]
    form, count = {}, {}
    for w in n:
        close = [v for v in n if near(w, v)]
        count[w] = len(close)
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n[w], count[w], n.get(form[w])) for w in n)


def got_variants(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def misspelt(rng: random.Random, letters: str, n: int) -> list[tuple]:
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(1, 40)):
            w = "".join(rng.choice(letters) for _ in range(rng.randint(4, 7)))
            words += [w] * rng.choice((1, 1, 2, 5, 20))
        rows.append((i, ", ".join(words)))
    return rows


def test_variants_odd_rows(spark, odd_rows):
    rows = [*odd_rows, *misspelt(random.Random(4), "aBé÷", 60), (99, "y" * 199_999 + " " + "y" * 199_999
            + " " + "y" * 199_999), (100, ("x" * 200_000 + " ") * 3)]
    df = op12.variant_groups(op12.vocabulary(frame(spark, rows)))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got_variants(df) == brute_variants(rows)
    assert op12.variant_groups(op12.vocabulary(frame(spark, []))).count() == 0


@pytest.mark.parametrize("limit", [1, 7])
def test_variants_of_split_shards(spark, limit):
    rows = misspelt(random.Random(limit), "abc", 150)
    df = op12.variant_groups(op12.vocabulary(frame(spark, rows)), limit=limit)
    assert got_variants(df) == brute_variants(rows)


# --- 13: source divergence

def brute_audit(rows) -> list[tuple]:
    docs = [tuple(x or "" for x in r) for r in rows]
    words = [[w.translate(LOWER) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]
             for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [(d[2], w) for d, w in zip(docs, words, strict=True) if d[1] == lang]
        df = Counter(x for _, w in mine for x in set(w))
        kept = [x for x, c in df.items() if c >= 3]
        count = {s: Counter() for s, _ in mine}
        for s, w in mine:
            count[s].update(x for x in w if df[x] >= 3)
        whole = sum(count.values(), Counter())

        def p(c, x, v=len(kept)):
            return 1 + 10**9 * (c[x] + 1) // (sum(c.values()) + v)

        def f(a, b):
            return (a - b) ** 2 // b
        for s, c in count.items():
            pairs = [("pair", t, sum(f(p(c, x), p(count[t], x)) for x in kept))
                     for t in count if t != s]
            terms = [("term", x, f(p(c, x), p(whole, x))) for x in kept
                     if c[x] and p(c, x) > p(whole, x)]
            for part in (pairs, sorted(terms, key=lambda r: (-r[2], r[1].encode()))[:200]):
                ranked = sorted(part, key=lambda r: (-r[2], r[1].encode()))
                out += [(lang, s, *r, k) for k, r in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("broadcast, block", [(100_000, 1 << 19), (0, 1 << 19)])
def test_source_audit(spark, odd_rows, monkeypatch, broadcast, block):
    monkeypatch.setattr(op13, "BROADCAST_GROUPS", broadcast)
    rng = random.Random(8)
    rows = [(t, rng.choice(["en", None, "fr"]), rng.choice(["s1", "", None, "s2", "été"]))
            for _, t, *_ in odd_rows]
    rows += [(prose(rng, rng.randint(0, 60)) + " ÉÉ Naïve  x-y z", rng.choice(["en", "fr"]),
              rng.choice(["s1", "s2", "s3", "s4"])) for _ in range(60)]
    rows += [(None, "de", "s1"), ("", "de", "s2"), ("once", "it", "s1"), ("word " * 9, "pt", "a")]
    df = frame(spark, [(i, r[0]) for i, r in enumerate(rows)]).drop("lang", "source").join(
        spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)],
                              "doc_id bigint, lang string, source string"), "doc_id")
    got = op13.source_divergence(df)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string",
                                "item": "string", "value": "bigint", "rank": "int"}
    assert sorted(map(tuple, got.collect())) == brute_audit(rows)
    assert op13.source_divergence(df.limit(0)).count() == 0


def test_weights_of_large_counts(spark):
    """Products beyond 64 bits are divided exactly."""
    cases = [(0, 7), (10**12, 3 * 10**12 + 1), (8 * 10**15, 9 * 10**15 - 1), (5, 6)]
    df = spark.createDataFrame(cases, "c long, n long").withColumn("w", op13.weight("c", "n"))
    got = {(r.c, r.n): r.w for r in df.collect()}
    assert got == {(c, n): 1 + 10**9 * (c + 1) // n for c, n in cases}
    numpy = op13._weights(np.array([c for c, _ in cases]), np.array([n for _, n in cases]))
    assert numpy.tolist() == [got[x] for x in cases]


def test_blocks_of_the_index_end_at_terms():
    import pyarrow as pa
    rng = random.Random(1)
    rows = sorted((lid, f"t{rng.randrange(40)}", g, rng.randint(1, 9)) for lid in (1, 2)
                  for g in range(5) for _ in range(60))
    rows = sorted({r[:3]: r for r in rows}.values())
    table = {"lid": [r[0] for r in rows], "term": [r[1] for r in rows], "gid": [r[2] for r in rows],
             "c": [r[3] for r in rows], "n": [100 + r[2] for r in rows], "v": [40] * len(rows)}
    batch = pa.RecordBatch.from_pydict(table)

    def total(batches):
        out = Counter()
        for b in op13._rows(iter(batches)):
            for r in b.to_pylist():
                out[r["lid"], r["g"], r["h"]] += r["value"]
        return out
    whole = total([batch])
    size, op13.BLOCK = op13.BLOCK, 7
    try:
        assert total([batch.slice(i, 3) for i in range(0, batch.num_rows, 3)]) == whole
    finally:
        op13.BLOCK = size


def test_counts_leave_the_task_in_bounded_tables(monkeypatch):
    import pyarrow as pa
    rng = random.Random(2)
    texts = [prose(rng, 50) for _ in range(30)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 30, "source": ["a", "b", "c"] * 10, "text": texts})

    def total():
        out, parts = Counter(), 0
        for b in op13._count(iter([batch])):
            parts += 1
            for r in b.to_pylist():
                out[r["source"], r["term"]] += 1000 * r["d"] + r["c"]
        return out, parts
    whole, _ = total()
    monkeypatch.setattr(op13, "TASK_TERMS", 20)
    cut, parts = total()
    assert cut == whole and parts > 10


def test_rows_of_equal_source_names_in_languages_stay_apart(spark):
    df = spark.createDataFrame([("a b", "en", "s"), ("a b", "en", "s"), ("a c", "en", "t"), ("a", "fr", "s")],
                               "text string, lang string, source string")
    got = op13.source_divergence(df).where(F.col("part") == "pair").collect()
    assert sorted((r.lang, r.source, r.item) for r in got) == [("en", "s", "t"), ("en", "t", "s")]


# --- earlier operators: what was mended

def test_article_text_is_kept_whatever_its_names_resemble():
    from thermograph.llm import op2_html_extract as op2
    page = ('<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be one</p>'
            '<p class="ad-hoc">kept text</p><div class="search-theory">about search</div>'
            '<svg><text>label</text></svg><div class="ad">buy</div><div class="comment-list">nice!</div>'
            '<div class="social share-buttons">tweet</div><p id="notice-board-history">old boards</p></article>')
    assert op2.split_page(page)[0] == "Let x=1 be one kept text about search label old boards"


def test_runs_that_two_pages_share_go(spark):
    from thermograph.llm import op2_html_extract as op2
    menu = "one two three four five six seven eight nine"
    pages = spark.createDataFrame(
        [(1, "http://h.example/a", f"<div>{menu}</div><div>first says this</div>"),
         (2, "http://h.example/b", f"<div>{menu}</div><div>another tells that</div>"), (3, "http://g.example/a", f"<div>{menu}</div>")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in op2.extract(pages).collect()}
    assert got == {1: "first says this", 2: "another tells that", 3: menu}


def shared_prefix(streams, host, at, run, min_pages):
    """By brute force: tokens of the longest prefix of host's stream ``at`` that
    ``min_pages`` pages of the host have (0: fewer than ``run``)."""
    def pages(tokens):
        n = len(tokens)
        return sum(p for h, s, p in streams if h == host and (
            s == tokens if n < run else any(s[i:i + n] == tokens for i in range(len(s) - n + 1))))
    for n in range(len(at), min(run, len(at)) - 1, -1):
        if n and pages(at[:n]) >= min_pages:
            return n
    return 0


def test_longest_repeats_of_a_host_by_brute_force(spark):
    from thermograph.llm import op2_html_extract as op2
    rng, run, seen, streams = random.Random(7), 3, set(), []
    menu = [rng.choice("abcd") for _ in range(23)]
    for i in range(60):
        s = [rng.choice("abcd") for _ in range(rng.choice((0, 1, 2, 5, 9)))]
        s = s + menu[:rng.randint(0, 23)] + s if i % 3 else s + ["a"] * rng.randint(0, 12)
        host = rng.choice("gh")
        if s and (host, *s) not in seen:
            seen.add((host, *s))
            streams.append((host, s, rng.choice((1, 1, 2))))
    df = spark.createDataFrame([(i, h, p, " ".join(s)) for i, (h, s, p) in enumerate(streams)],
                               "_sid long, _host string, _pages long, _stream string")
    for min_pages in (2, 3):
        got = {}
        for r in op2.longest_repeats(df, run, min_pages, depth=4).collect():
            got.setdefault(r._sid, {})[r.position] = r.length
        for i, (h, s, _) in enumerate(streams):
            # A stream shorter than the run is one suffix, the whole.
            want = {j: shared_prefix(streams, h, s[j:], run, min_pages)
                    for j in range(max(1, len(s) - run + 1))}
            mine = got.get(i, {})
            assert all(want[j] == n for j, n in mine.items())
            assert max(mine.values(), default=0) == max(want.values())
            for repeats in (want, mine):
                repeats["all"] = {j + k for j, n in repeats.items() for k in range(n)}
            assert mine["all"] == want["all"]


def test_neighbours_in_a_shard_whatever_is_held():
    from thermograph.llm import op2_html_extract as op2
    rng = random.Random(3)
    rows = sorted((rng.randint(0, 3), b"".join(rng.choice((b"a", b"b")) * 8 for _ in range(rng.randint(1, 6))),
                   rng.randint(0, 5), 1) for _ in range(300))
    for min_pages in (1, 2, 4):
        s = op2.Shards(min_pages, 10_000)
        want = [*(x for r in rows for x in s.add(r)), *s.finish()]
        for (shard, key, _, _), n in want:
            full = [k for k in range(len(key) // 8 + 1) if len(
                {r[2] for r in rows if r[0] == shard and r[1][:8 * k] == key[:8 * k]}) >= min_pages]
            assert n == max(full, default=0)
        for held in (1, 7):
            s = op2.Shards(min_pages, held)
            assert [*(x for r in rows for x in s.add(r)), *s.finish()] == want


def test_pages_tell_their_longest_repeat(spark):
    from thermograph.llm import op2_html_extract as op2
    menu, more = "one two three four five six seven eight nine", "ten eleven twelve"
    pages = spark.createDataFrame(
        [(1, "http://h.example/a", f"<div>{menu} {more}</div><div>first says this</div>"),
         (2, "http://h.example/b", f"<div>{menu} {more}</div><div>another tells that</div>"),
         (3, "http://h.example/c", f"<div>{menu}</div><div>and a third one</div>"),
         (4, "http://h.example/d", f"<nav>{menu} {more}</nav><article>{menu} is the article</article>"),
         (5, "http://g.example/a", f"<div>{menu}</div>"), (6, "http://h.example/e", None)],
        "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_repeated, r.longest_repeat) for r in op2.extract(pages).collect()}
    assert got == {1: ("first says this", 12, 12), 2: ("another tells that", 12, 12),
                   3: ("and a third one", 9, 9), 4: (f"{menu} is the article", 0, 12),
                   5: (menu, 0, 0), 6: ("", 0, 0)}


def test_many_spans_in_one_text():
    import time

    from thermograph.llm import op1_secret_scan as op1, op8_license_scan as op8
    begun = time.perf_counter()
    spans = op1.scan("password=abcdefghijkl " * 30_000)
    assert len(spans) == 30_000 and spans[-1][2] == 22 * 30_000 - 1
    index = op8.Index()
    template = max(range(len(index.words)), key=lambda t: -len(index.words[t]))
    kept = op8.scan(list(index.words[template]) * 3, [], index)
    assert kept == [] and time.perf_counter() - begun < 30


def test_articles_go_through_the_array(spark):
    from thermograph.llm import op2_html_extract as op2
    line = "this line of ten words is in two articles here"
    pages = spark.createDataFrame(
        [(1, "http://h.example/a", f"<nav>a b c</nav><article><p>first</p><p>{line} and</p></article>"),
         (2, "http://h.example/b", f"<main><p>{line}</p> but</main>"),
         (3, "http://h.example/c", "<article>none of them</article>"),
         (4, "http://h.example/d", f"<div>{line}</div>"),  # as in articles: no menu
         (5, "http://g.example/a", f"<article>{line}</article>"),
         (6, "http://f.example/a", f"<article>{line}</article>"), (6, "http://f.example/a", f"<article>{line}</article>"),
         (7, "http://e.example/a", "<article>short one</article>"), (8, "http://e.example/b", "<article>short one</article>")],
        "page_id long, url string, html string")
    got = sorted((r.page_id, r.text, r.n_repeated, r.longest_repeat, r.article_repeat)
                 for r in op2.extract(pages).collect())
    assert got == [(1, f"first {line} and", 0, 0, 10), (2, f"{line} but", 0, 0, 10), (3, "none of them", 0, 0, 0),
                   (4, line, 0, 0, 0), (5, line, 0, 0, 0), (6, line, 0, 0, 0), (6, line, 0, 0, 0),
                   (7, "short one", 0, 0, 2), (8, "short one", 0, 0, 2)]
