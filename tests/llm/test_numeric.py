"""The vectorised helpers against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from thermograph.llm._text import Words, shingle_sets, text_slices
from thermograph.llm.op3_jaccard_join import (LEVELS, band_of, linked, link_tile, max_difference,
                                              parts_by_level, set_ids)
from thermograph.llm.op6_line_dedup import cluster
from thermograph.llm.op9_language_id import marginals


def test_words_are_those_of_bytes_split():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB \t\n\x0bé  z.") for _ in range(rng.randint(0, 60)))
             for _ in range(300)] + ["", " ", "\n\n"]
    w = Words(pa.array(texts, pa.large_string()), lower=True)
    raw = w.buf.tobytes()
    got = [raw[a:b] for a, b in zip(w.start, w.end, strict=True)]
    assert got == [x for t in texts for x in t.encode().lower().split()]
    assert np.diff(w.first).tolist() == [len(t.encode().split()) for t in texts]
    h = dict(zip(got, w.hashes().tolist(), strict=True))
    assert len(set(h.values())) == len(h)


def test_slices_hold_whole_texts():
    texts = ["a" * 10, None, "b" * 1000, "", "c" * 3]
    out = [(i, j, t.to_pylist()) for i, j, t in text_slices(pa.array(texts), 12)]
    assert sum((t for _, _, t in out), []) == [x or "" for x in texts]
    assert [i for i, _, _ in out][0] == 0 and out[-1][1] == 5


def test_shingle_sets_of_short_and_long_rows():
    texts = ["", "a b", "a b", "b a", "a b c d e f", "a b c d e a b c d e f", "A B C D E F"]
    row, _ = shingle_sets(Words(pa.array(texts, pa.large_string()), lower=True), len(texts), 5)
    assert np.bincount(row, minlength=7).tolist() == [0, 1, 1, 1, 2, 6, 2]
    row, value = shingle_sets(Words(pa.array(texts, pa.large_string()), lower=True), len(texts), 5)
    size, sid = set_ids(row, value, len(texts))
    assert sid[1] == sid[2] != sid[3] and sid[4] == sid[6] and (sid % 2 == 0).all()


def test_largest_difference_is_a_bound():
    for a in range(1, 60):
        for b in range(a, a * 100 // 80 + 1):
            need = -(-80 * (a + b) // 180)
            assert a + b - 2 * need <= max_difference(a, 80)


def test_some_level_always_holds():
    rng = np.random.default_rng(2)
    sizes = np.arange(1, 400)
    row = np.repeat(np.arange(len(sizes)), sizes)
    value = rng.integers(0, 2**63, len(row)).astype(np.uint64)
    order = np.lexsort((value, row))
    parts = parts_by_level(row, value[order], sizes, 80)
    assert parts.shape[1] == len(LEVELS) + 1
    assert (parts[:, -1] > max_difference(sizes, 80)).all()
    assert (band_of(np.array([1, 2, 3, 4, 7, 8])) == [0, 1, 1, 2, 2, 3]).all()


def test_tile_links_all_pairs():
    rng = random.Random(5)
    base = [rng.getrandbits(63) for _ in range(200)]
    sets = []
    for _ in range(60):
        s = set(base[rng.randint(0, 40):160 + rng.randint(0, 40)])
        s |= {rng.getrandbits(63) for _ in range(rng.randint(0, 40))}
        sets.append(np.array(sorted(s), np.uint64))
    forest = link_tile(sets, None, 80)
    up = list(range(60))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(60):
        for j in range(i):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            is_link = 100 * len(a & b) >= 80 * len(a | b)
            assert linked(sets[i], sets[j], 80) == is_link
            if is_link:
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    assert [forest.root(x) for x in range(60)] == [root(x) for x in range(60)]


def test_cluster_generalises_variable_words():
    words = np.array([[1, 2, 3, 4, 5, 6, 7], [1, 2, 3, 9, 5, 6, 7], [1, 2, 3, 8, 5, 6, 0],
                      [1, 2, 3, 40, 50, 60, 70]], np.uint16)
    out = cluster(words, np.array([5, 2, 1, 1]))
    assert out[0] == out[1] == out[2] != out[3]


def test_marginals_are_those_of_every_path():
    rng = np.random.default_rng(1)
    trans = rng.normal(size=(3, 3))
    count = np.array([5, 0, 1, 300, 7])
    emit = rng.normal(size=(int(count.sum()), 3))
    got, expected = marginals(emit, count, trans, True)
    at, pair = 0, np.zeros((3, 3))
    for n in count:
        e, a = np.exp(emit[at:at + n]), np.exp(trans)
        f, b = np.zeros((n, 3)), np.ones((n, 3))
        for t in range(n):
            f[t] = e[t] * (f[t - 1] @ a if t else 1)
            f[t] /= f[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = a @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        p = f * b
        assert np.allclose(got[at:at + n], p / p.sum(axis=1, keepdims=True), atol=1e-5)
        for t in range(n - 1):
            x = f[t][:, None] * a * (e[t + 1] * b[t + 1])[None]
            pair += x / x.sum()
        at += n
    assert np.allclose(expected, pair, atol=1e-3)
