"""Each operator against brute force, and on rows that are odd in some way."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.odd_tables import frame, odd_rows, prose  # noqa: F401
from thermograph.llm._text import Words, shingle_sets
from thermograph.llm import (op1_secret_scan as op1, op2_html_extract as op2,
                             op3_jaccard_join as op3, op4_quality_rules as op4,
                             op5_chat_format as op5, op6_line_dedup as op6, op7_bpe as op7,
                             op8_license_scan as op8, op9_language_id as op9,
                             op10_decontaminate as op10)

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# --- 1: secrets

def test_secret_spans(spark, odd_rows):
    key = "AKIA" + "Q7ZP2M4X8K1J5H3D"
    blob = "h7Gk2Lq9Zx4Vb1Nm8Tr5Yw3Pc6Jd0Fs"
    texts = [f'a password = "abcdefghijkl" b {key} c 0123456789abcdef', "token:token : abcdefghijkl",
             f"x {blob} y", "secret: short", "API-KEY=abcdefghijklmnop api_key=abcdefghijklmnop",
             "the getUserNameFromDatabase2Connection and my-very-long-file-name-2024-01-05",
             "ſecret=abcdefghijklmnop"]
    df = frame(spark, [*odd_rows, *[(100 + i, t) for i, t in enumerate(texts)]])
    got = rows(op1.secret_spans(df))
    assert len(got) == len(odd_rows) + len(texts)
    by = {r["doc_id"]: r["spans"] for r in got}
    for i, t in [*odd_rows, *[(100 + i, t) for i, t in enumerate(texts)]]:
        want = [(op1.KINDS[k], s, e) for s, k, e in op1.scan(t or "")]
        assert [(x["kind"], x["start"], x["end"]) for x in by[i]] == want or i is None
    assert [x["kind"] for x in by[100]] == ["assign", "access", "hex"]
    assert by[101] == [] and by[103] == [] and by[105] == [] and by[106] == []
    assert [(x["kind"], texts[2][x["start"]:x["end"]]) for x in by[102]] == [("random", blob)]
    assert [x["start"] for x in by[104]] == [texts[4].index("api_key")]
    clean = {r["doc_id"]: r["text"] for r in rows(op1.redact(df))}
    assert clean[102] == "x <secret> y" and clean[2] is None
    assert op1.secret_spans(df.limit(0)).count() == 0


def test_battery_has_power_and_few_false_alarms():
    rng = random.Random(1)
    for name, alphabet in (("hex", op1.ALPHABETS["HEX"]), ("b64", op1.ALPHABETS["base64"])):
        hit = sum(bool(op1.random_spans("".join(rng.choice(alphabet) for _ in range(40))))
                  for _ in range(200))
        assert hit >= 190, name
    names = ["".join(rng.choice(["get", "User", "Name", "data", "Table", "List", "index"])
                     for _ in range(7)) + str(rng.randint(0, 99)) for _ in range(500)]
    assert sum(bool(op1.random_spans(x)) for x in names) <= 5


@pytest.mark.parametrize("alphabet", ["low", "up", "letters", "HEX", "base32", "base36", "BASE36", "base64"])
def test_battery_finds_tokens_of_every_alphabet(alphabet):
    rng = random.Random(alphabet)
    a = op1.ALPHABETS[alphabet]
    tokens = ["".join(rng.choice(a) for _ in range(n)) for n in (32, 40) for _ in range(400)]
    hits = [bool(op1.random_spans(t)) for t in tokens]
    assert sum(hits[:400]) >= 360 and sum(hits[400:]) >= 380


def test_names_and_long_words_are_no_secrets():
    rng = random.Random(6)
    usual = ("session window manager factory abstract connection pool handler default index query size value "
             "next buffer result list name user data table process service client request response with for "
             "Verordnung internationale information ministerstwo nacional administration").split()
    # Every other one has a letter that is rare in words.
    rare = "jump quick fix exact zone box key json schiff und kraft Maximum Geschwindigkeit size".split()
    for words, share in ((usual, 0.01), (usual + rare, 0.05)):
        for join in ("", "_", "-", "/"):
            for case in (str, str.title, str.upper):
                names = [join.join(case(w) for w in rng.choices(words, k=rng.randint(4, 7)))
                         for _ in range(400)]
                hits = sum(bool(op1.random_spans(x)) for x in names)
                assert hits <= share * len(names) * (not join), (join, case, hits)
    for x in ("donaudampfschifffahrtsgesellschaft", "rindfleischetikettierungsgesetz", "x" * 5000,
              "incomprehensibilities", "antidisestablishmentarianism", "aaaaaaaaaabbbbbbbbbbcccccccccc"):
        assert not op1.random_spans(x), x


def plain_base_spans(text):
    """The fixed patterns, matched place by place."""
    value = set(op1.DIGITS + op1.LOW + op1.LOW.upper() + "+/_.=-")
    upper, hexa = set(op1.DIGITS + op1.LOW.upper()), set(op1.DIGITS + "abcdef")
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    run = lambda at, chars: next((k for k in range(at, len(text)) if text[k] not in chars), len(text))

    def assign(at):
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if fold.startswith(word, at):
                k = at + len(word)
                k += text[k:k + 1] in ("'", '"')
                k = run(k, " ")
                if text[k:k + 1] in ("=", ":") and k < len(text):
                    v = run(k + 1, " ")
                    v += text[v:v + 1] in ("'", '"')
                    v = run(v, " ")
                    # "=" is also a character of values; nothing else can be given back.
                    end = run(v, value)
                    if end > v:
                        return end, end - v >= 12
        return None

    def access(at):
        if text.startswith("AKIA", at) and (end := run(at + 4, upper)) > at + 4:
            return end, end - at >= 18
        return None

    def hexes(at):
        end = run(at, hexa)
        return (end, end - at >= 16) if end > at else None
    out = []
    for kind, match in (("assign", assign), ("access", access), ("hex", hexes)):
        at = 0
        while at < len(text):
            got = match(at)
            if got and got[1]:
                out.append((kind, at, got[0]))
            at = got[0] if got else at + 1
    return sorted(out, key=lambda x: (x[1], op1.KINDS.index(x[0])))


def test_fixed_patterns_place_by_place(spark):
    rng = random.Random(8)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIkey", "AKIA", "=", ":", " ", '"', "'",
            "Q7ZP2M4X8K1J5H", "0123456789abcdef", "abcdefghijkl", "short", "é", "\n", "deadbeef", ".", "ſ"]
    docs = [(i, "".join(rng.choices(bits, k=rng.randint(0, 40)))) for i in range(1500)]
    got = {r.doc_id: [(x.kind, x.start, x.end) for x in r.spans if x.kind != "random"]
           for r in op1.secret_spans(frame(spark, docs)).collect()}
    assert got == {i: plain_base_spans(t) for i, t in docs}


def test_tails_and_false_discovery_control():
    for n, p in ((20, 0.2), (60, 0.52)):
        for k in range(n + 1):
            exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k, n + 1))
            got = op1.binomial_tail(k, n, p)
            assert abs(got - exact) < 1e-9 or k <= n * p and got == 1.0
    for df, x, tail in ((3, 7.815, 0.05), (3, 16.266, 0.001), (7, 14.067, 0.05), (10, 29.588, 0.001)):
        assert abs(op1.chi2_tail(x, df) / tail - 1) < 0.2
    # Each discovery has as many others as its own p-value needs.
    rng = random.Random(4)
    runs = ["".join(rng.choice(op1.ALPHABETS["base36"]) for _ in range(rng.randint(20, 30))) for _ in range(30)]
    text = " ".join(runs)
    found = {text[s:e] for s, e in op1.random_spans(text)}
    known = [(r, op1.text_p(r), op1.encoding(r)) for r in runs if op1.encoding(r)]
    mean = sum(len(r) for r, _, _ in known) / len(known)
    q = {r: p * mean / len(r) for r, p, _ in known}
    ok = [k for k in range(1, len(q) + 1) if sum(v <= op1.FDR * k / len(q) for v in q.values()) >= k]
    limit = op1.FDR * max(ok, default=0) / len(q)
    assert found == {r for r, _, a in known
                     if q[r] <= limit and op1.uniform_p(r, op1.ALPHABETS[a]) >= op1.REJECT / 3}


# --- 2: pages

def test_pages(spark):
    shared = "Join our mailing list today for the best offers of the whole long week ahead"
    pages = [(i, f"http://h.example/{i}", f"<body><div>{shared}</div><p>n{i} {prose(random.Random(i), 30)}"
              f"</p><div class='comments'>no</div></body>") for i in range(5)]
    pages += [(50, "http://a.example/", "<main><h1>T&amp;t</h1><article><header>x</header><p>one <b>t</b>wo&nbsp;"
               "\n three<aside>side</aside><form>f</form><script>if (a<b) {}</script></article></main><footer>f"),
              (51, None, None), (52, "", ""), (53, "x", "plain &lt;text&gt;"), (50, "http://a.example/", "<p>b"),
              (54, "http://a.example/", "<article>" + "<p>w <i>" * 20_000)]
    df = spark.createDataFrame([(*p, 1, "c", 2) for p in pages],
                               "page_id bigint, url string, html string, text int, _uid string, _open int")
    got = rows(op2.extract(df))
    assert len(got) == len(pages)
    by = {(r["page_id"], r["text"]): r for r in got}
    assert (50, "one two three") in by and (51, "") in by and (52, "") in by
    assert (53, "plain <text>") in by and (50, "b") in by and by[50, "b"]["n_chars"] == 1
    for i in range(5):  # the shared run goes, the page's own run stays
        text = f"n{i} {prose(random.Random(i), 30)}"
        assert by[i, text]["n_repeated"] == len(shared.split())
    assert op2.extract(df.limit(0)).count() == 0


# --- 3: Jaccard

def brute_components(docs):
    def shingles(t):
        w = (t or "").encode().lower().split()
        if not w:
            return frozenset()
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            best[root(i)] = min(d, best.get(root(i), d))
    return sorted((d, len(sets[i]), best.get(root(i)) if sets[i] else d)
                  for i, (d, _) in enumerate(docs) if d is not None)


def near_copies(n_base, n_copy, seed=4):
    rng = random.Random(seed)
    passage = prose(rng, 70)
    out = []
    for b in range(n_base):
        base = prose(rng, rng.randint(5, 260)).split()
        for _ in range(n_copy):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = "Changed"
            out.append(" ".join(w) + (" " + passage if b % 2 else ""))
    return list(enumerate(out, 10))


@pytest.mark.parametrize("block,limit", [(512, 500_000), (3, 0)])
def test_components(spark, odd_rows, monkeypatch, block, limit):
    monkeypatch.setattr(op3, "BLOCK", block)
    monkeypatch.setattr(op3, "BROADCAST_ROWS", limit)
    docs = [r for r in odd_rows if r[0] not in (1, None)] + near_copies(8, 7)
    got = rows(op3.jaccard_components(frame(spark, docs)))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(docs)


def test_components_of_odd_rows(spark, odd_rows):
    got = rows(op3.jaccard_components(frame(spark, odd_rows)))
    assert len(got) == len(odd_rows)
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 8)} == {1}
    assert all(r["component_id"] == r["doc_id"] for r in got if r["n_shingles"] == 0)
    left = op3.one_of_each(frame(spark, odd_rows))
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(1) == 2 and 8 not in ids and ids.count(None) == 2
    empty = frame(spark, odd_rows).limit(0)
    assert op3.jaccard_components(empty).count() == 0 == op3.one_of_each(empty).count()


def test_a_common_passage_makes_no_candidates(spark, monkeypatch):
    # A document that is little else than a passage looks at the passage's keys; those
    # that only contain it can link with nothing, and aren't brought together there.
    rng, rows_of = random.Random(6), {}
    words = [f"w{i}" for i in range(20_000)]
    passage = [rng.choice(words) for _ in range(36)]
    docs = [(i, " ".join(passage + [rng.choice(words) for _ in range(20)])) for i in range(60)]
    docs += [(90, " ".join([*passage, "x"])), (91, " ".join([*passage, "y"])), (92, docs[3][1] + " z")]
    keep = op3.written

    def written(spark, df, name):
        out = keep(spark, df, name)
        rows_of[name] = out.count()
        return out
    monkeypatch.setattr(op3, "written", written)
    monkeypatch.setattr(op3, "BROADCAST_ROWS", 2)  # tiles are broadcast in turns
    got = rows(op3.jaccard_components(frame(spark, docs)))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(docs)
    assert rows_of["op3-members"] == 4


def test_keys_are_packed_whole():
    rng = np.random.default_rng(2)
    for n, buckets in ((1, 1), (5000, 1), (5000, 7)):
        key = rng.integers(0, 2**64, n, np.uint64)
        key[n // 2:] = key[:n - n // 2]  # keys of two sets
        tag = rng.integers(0, 2**32, n).astype(np.uint32)
        got = sorted((b, x) for b, keys, tags in op3.pack(key, tag, buckets)
                     for x in op3.unpack(keys, tags).tolist())
        assert got == sorted((int(k >> 32) * buckets >> 32, (int(k) & 0xFFFFFFFF) << 32 | int(t))
                             for k, t in zip(key.tolist(), tag.tolist(), strict=True))


def test_sets_whose_ids_agree_in_the_bits_that_travel(spark):
    rng = random.Random(9)
    base, seen, pair = prose(rng, 60).split(), {}, None
    for _ in range(30):
        texts = [" ".join([*base, f"a{rng.getrandbits(60)}"]) for _ in range(10_000)]
        row, value = shingle_sets(Words(pa.array(texts, pa.large_string()), lower=True), len(texts), 5)
        for t, s in zip(texts, op3.set_ids(row, value, len(texts))[1].tolist(), strict=True):
            if (other := seen.setdefault(s >> 33, t)) != t:
                pair = other, t
        if pair:
            break
    docs = [(1, pair[0]), (2, pair[1])]
    assert brute_components(docs)[1][2] == 1
    got = rows(op3.jaccard_components(frame(spark, docs)))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(docs)


# --- 4: quality

def test_quality(spark, odd_rows):
    rng = random.Random(8)
    good = prose(rng, 60) + ".\n" + prose(rng, 60) + "."
    docs = [*odd_rows, (20, good + "\nHome | About | Contact | Imprint\nClick here to log in.\nMenu"),
            (21, "\n".join(["a | b | c | d | e | f"] * 20) + "\n" + prose(rng, 50) + "."),
            (22, " ".join(w + "!!" for w in good.upper().split())), (23, "same words again " * 40)]
    got = rows(op4.quality(frame(spark, docs), with_text=True))
    assert len(got) == len(docs)
    by = {r["doc_id"]: r for r in got}
    assert by[20]["kept"] and by[20]["clean_text"] == good and by[20]["n_failed_lines"] == 3
    assert not (by[21]["kept"] or by[22]["kept"] or by[23]["kept"])
    assert by[21]["n_dup_lines"] == 19 and by[23]["n_repeat_words"] == 120 and by[23]["base_failed"]
    assert by[2]["n_words"] == 0 and by[2]["clean_text"] is None and by[4]["word_chars"] == 0
    left = op4.clean(frame(spark, docs))
    assert left.columns == frame(spark, docs).columns
    assert all(r.n_chars == len(r.text) for r in left.collect())
    assert op4.quality(frame(spark, docs).limit(0)).count() == 0


# --- 5: chat

def test_layouts_and_reading_back(spark):
    hard = "a \\s <s>[user] </s> \\\\l [INST]\n]"
    recs = [{"messages": [{"role": "user", "content": hard}, {"role": "assistant", "content": None},
                          {"role": "assistant", "content": hard}], "extra": {"text": 1}},
            {"instruction": "do", "input": "x", "output": "y"}, {"instruction": "do", "output": "y"},
            {"prompt": "p", "response": "q", "system": "s"}, {"prompt": "p", "completion": ""},
            {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g]"}]},
            {"question": "q", "answer": "a"}, {"other": 1}, {"messages": []}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)] + [(90, "no"), (91, None)],
                               "id int, js string")
    out = op5.format_turns(op5.canonical(op5.records(df, "js"), "record"))
    got = {r["id"]: r for r in rows(out.select(
        "id", "layout", "turns", op5.read_back(F.col("formatted")).alias("back"),
        op5.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss")))}
    assert all(r["back"] == r["turns"] for r in got.values())
    assert got[0]["turns"][0]["text"] == hard and got[0]["loss"] == hard
    assert [got[i]["layout"] for i in range(9)] == [
        "messages", "instruction", "instruction", "prompt_response", "prompt_completion", "sharegpt",
        "question_answer", "unknown", "unknown"]
    assert got[1]["turns"] == [{"role": "user", "text": "do\n\nx"}, {"role": "assistant", "text": "y"}]
    assert got[90]["turns"] == [] == got[91]["turns"]


def test_turn_rows(spark):
    data = [(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, None, "x"), (1, 1, "assistant", "b"),
            (2, None, "tool]", "<t>")]
    df = spark.createDataFrame([(*d, 1, 2) for d in data],
                               "conv_id bigint, turn bigint, role string, text string, turns int, record int")
    own = op5.gather_turns(df)
    back = {r["conv_id"]: r for r in rows(op5.format_turns(op5.canonical(op5.records(own), "record")).select(
        "conv_id", op5.read_back(F.col("formatted")).alias("back"),
        op5.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss")))}
    assert [t["text"] for t in back[1]["back"]] == ["", "b", "b"] and back[1]["loss"] == "bb"
    assert back[2]["back"] == [{"role": "tool]", "text": "<t>"}]
    assert back[None]["back"] == [{"role": "", "text": "x"}]
    assert op5.gather_turns(df.limit(0)).count() == 0


# --- 6: lines

@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_lines(spark, odd_rows, monkeypatch, limit):
    monkeypatch.setattr(op6, "BROADCAST_ROWS", limit)
    rng = random.Random(2)
    log = "user 12 logged in from host 10.0.0.1 at the usual place today"
    passage = prose(rng, 60)
    own = [prose(rng, 40) for _ in range(6)]
    edited = passage.split()
    edited[20] = edited[31] = "other"
    docs = [*odd_rows, (20, own[0] + "\n" + passage), (21, passage + "\n" + own[1]),
            (22, own[2] + "\n" + " ".join(edited)), (23, own[3] + "\n" + log),
            (24, own[4] + "\n\n" + log.replace("12", "77").replace("10.0.0.1", "host9")), (25, "one two"),
            (26, "one two")]
    got = {}
    for r in rows(op6.dedup_lines(frame(spark, docs))):
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(docs)
    text = {k: v[0]["text"] for k, v in got.items()}
    assert text[20] == own[0] + "\n" + passage and text[21] == own[1] and text[22] == own[2]
    assert text[23] == own[3] + "\n" + log and text[24] == own[4] + "\n"
    assert text[25] == text[26] == "one two" and text[2] is None and text[3] == ""
    assert [r["n_dropped"] for r in got[1]] == [0, 0] and [r["n_dropped"] for r in got[None]] == [0, 0]
    left = op6.drop_lines(frame(spark, docs))
    assert left.columns == frame(spark, docs).columns
    assert all(r.n_chars == len(r.text) for r in left.collect() if r.text is not None)
    assert op6.dedup_lines(frame(spark, docs).limit(0)).count() == 0


def test_templates_do_not_depend_on_the_order_of_rows():
    rng = random.Random(9)
    lines = [[rng.randint(0, 2) if k > 4 else k for k in range(12)] for _ in range(40)]
    entries = [(hash(tuple(x)), 1, i, op6.np.array(x, op6.np.uint16).tobytes())
               for i, x in enumerate(lines)]
    entries = list({e[0]: e for e in entries}.values())

    def run(rows):
        return sorted(op6._leaf(*(list(c) for c in (
            [e[0] for e in rows],)), 12, *(list(c) for c in zip(*[e[1:] for e in rows], strict=True))))
    want = run(entries)
    for _ in range(5):
        rng.shuffle(entries)
        assert run(entries) == want


def test_a_template_recurs_at_every_size(spark):
    rng = random.Random(12)
    names = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
                    for _ in range(4200)})
    docs = [(i, f"Posted by user {x} in the general forum of this site") for i, x in enumerate(names)]
    got = rows(op6.dedup_lines(frame(spark, docs)))
    assert [r["doc_id"] for r in got if not r["n_dropped"]] == [0]


def word_code(w):
    return int(op6.Lines(pa.array([w], pa.large_string())).word[0])


def plain_line_dedup(docs):
    """What ``dedup_lines`` is to return for the (id, text) of ``docs``, word by word."""
    space = re.compile("[^ \t\n\x0b\x0c\r]+")
    code = lambda w: "#" if any(c in "0123456789" for c in w) else w
    lines = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            if key := tuple(code(w) for w in space.findall(line)):
                lines.setdefault(key, set()).add(i)
    support = Counter()
    for key, ids in lines.items():
        for p, w in enumerate(key):
            support[len(key), key[:3], p, w] += len(ids)
    usual = {}
    rank = lambda w: word_code(w if w != "#" else "0")
    for (n, lead, p, w), k in support.items():
        usual[n, lead, p] = min(usual.get((n, lead, p), (0, 0, "")), (-k, rank(w), w))
    kinds = {}
    for key, ids in lines.items():
        n, lead = len(key), key[:3]
        own = [support[n, lead, p, w] for p, w in enumerate(key)]
        level = sorted(own[3:], reverse=True)[max(1, math.ceil(0.7 * n - 1e-9) - 3) - 1] if n > 3 else 0
        shape = tuple(usual[n, lead, p][2] if p > 2 and 2 * k <= level else key[p]
                      for p, k in enumerate(own))
        kinds.setdefault(shape, []).append((key, ids))
    first = {}
    for shape, members in kinds.items():
        docs_of = [i for _, ids in members for i in ids]
        if len(docs_of) >= 2 and len(docs_of) * len(shape) >= op6.WEIGHT:
            first.update((key, min(docs_of)) for key, _ in members)
    out = []
    for i, text in docs:
        left = [line for line in (text or "").split("\n")
                if first.get(tuple(code(w) for w in space.findall(line)), i) == i]
        out.append((i, "\n".join(left)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_templates_as_in_plain_python(spark, monkeypatch, seed):
    rng = random.Random(seed)
    # Words travel as 16-bit hashes: none of these share one.
    some = list({word_code(w): w for w in sorted({*prose(rng, 400).split()})}.values())
    kinds = [rng.choices(some, k=rng.choice([4, 9, 17])) for _ in range(12)]
    lead = ["one two three", "12 12:00 7"]
    docs = []
    for i in range(300):
        lines = []
        for _ in range(rng.randint(0, 4)):
            w = list(rng.choice(kinds))
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice([rng.choice(rng.choice(kinds)), rng.choice(some), str(i)])
            lines.append(rng.choice(lead) + " " + " ".join(w))
        docs.append((i, "\n".join(lines)))
    df = frame(spark, docs)
    want = plain_line_dedup(docs)
    assert want != sorted(docs)
    done = lambda: sorted((r.doc_id, r.text) for r in op6.dedup_lines(df).collect())
    assert done() == want
    # The plan of large leaves, split groups and a small table in the tasks change nothing.
    for name, value in (("LEAF_WORDS", 100), ("SALT_LINES", 7), ("HELD", 2000)):
        monkeypatch.setattr(op6, name, value)
    assert done() == want


def test_a_leaf_of_unlike_lines_takes_a_fixed_number_of_jobs(spark, monkeypatch):
    monkeypatch.setattr(op6, "LEAF_WORDS", 1000)
    parts = "ab cd ef gh ij kl mn op".split()

    def jobs(n):
        rng = random.Random(n)
        lines = spark.createDataFrame(
            [(i, f"{i} 12:00 {i * 7} " + " ".join("".join(rng.choices(parts, k=6)) for _ in range(8)))
             for i in range(n)], "doc_id long, text string")
        spark.sparkContext.setJobGroup(f"lines-{n}", "")
        assert op6.recurring_lines(lines).count() == 0
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"lines-{n}"))
    few, many = jobs(500), jobs(20_000)
    spark.sparkContext.setJobGroup("", "")
    assert many <= few + 3


def test_varying_places_become_variable(spark):
    """Two words vary at once, and each of their values is frequent."""
    rng = random.Random(5)
    who, what = (prose(rng, 40).split() for _ in range(2))
    docs = [(i, f"the job of user {rng.choice(who)} was put in queue {rng.choice(what)} by the clock")
            for i in range(3000)]
    got = rows(op6.dedup_lines(frame(spark, docs)))
    assert sorted(r["doc_id"] for r in got if not r["n_dropped"])[0] == 0
    assert sum(not r["n_dropped"] for r in got) == 1


# --- 7: tokens

def test_tokens(spark, odd_rows):
    import public_tokenizers
    import tiktoken
    ranks = op7.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                               special_tokens={})
    odd = [(30, "it's  <|endoftext|>\n\n x ՘\U000323b0 ⅰ\x00 \t\U00011de0 \U0001f469‍\U0001f680")]
    docs = [r for r in [*odd_rows, *odd] if r[0] != 7] + [(40 + i, r[1]) for i, r in enumerate(odd_rows[:3])]
    df = frame(spark, docs)
    ids = op7.encode(df, ranks, public_tokenizers.PATTERN)
    got = sorted(((r["doc_id"] or -1, r["ids"]) for r in rows(ids)))
    assert got == sorted((d or -1, theirs.encode_ordinary(t or "")) for d, t in docs)
    back = sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode()) for r in rows(op7.decode(ids, ranks)))
    assert back == sorted((d or -1, t or "") for d, t in docs)
    digest = {r["doc_id"]: r for r in rows(op7.bpe_digests(df))}
    x = theirs.encode_ordinary(odd[0][1])
    assert digest[30]["ids_sha256"] == hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
    assert digest[2]["n_tokens"] == 0
    assert op7.bpe_digests(df.limit(0)).count() == 0


# --- 8: licenses

def test_licenses(spark, odd_rows):
    full = op8.TEMPLATES[0][1]
    edited = full.replace("free of charge", "at no charge").replace("rights to use", "right to use")
    docs = [*odd_rows, (20, f"é x. {full}\nMore."), (21, f"{edited} end"),
            (22, "All rights reserved.\n" * 3), (23, "Licensed under the sun"),
            (24, "LICENSED UNDER CC BY-NC 4.0, and all rights reserved")]
    got = {r["doc_id"]: r["spans"] for r in rows(op8.license_spans(frame(spark, docs)))}
    text = dict(docs)
    assert [(s["license"], s["coverage"]) for s in got[20]] == [("MIT", 1.0)]
    s = got[20][0]
    assert text[20][s["start"]:s["end"]] == full[:-1]
    assert got[21][0]["license"] == "MIT" and 0.9 < got[21][0]["coverage"] < 1
    assert [(x["license"], x["start"]) for x in got[22]] == [("proprietary", 21 * i) for i in range(3)]
    assert got[23] == [] and [x["license"] for x in got[24]] == ["CC-BY-NC-4.0", "proprietary"]
    assert all(got[i] == [] for i in (1, 2, 3, 4, None, 7))
    assert op8.license_spans(frame(spark, docs).limit(0)).count() == 0


# --- 9: languages

def test_held_out_accuracy_and_odd_rows(spark, odd_rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op9.fit(docs)
    got = rows(op9.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id"))
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(got) == 1000
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    texts = {r.lang: r.text for r in docs.collect()}
    mixed = op9.predict(op9.pa.array([texts["en"], texts["de"]], op9.pa.large_string()), model)
    assert [model.labels[x] for x in mixed[0]] == ["en", "de"]
    odd = rows(op9.identify(frame(spark, [*odd_rows, (50, "12 .. … !")]), model))
    assert len(odd) == len(odd_rows) + 1 and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["lang_pred"] for r in odd if r["doc_id"] in (2, 3, 4, 50)} == {"und"}
    none = op9.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in rows(op9.identify(docs.limit(20), none))} == {"und"}
    assert op9.identify(docs.limit(0), model).count() == 0


def test_training_sees_no_held_out_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r.text for r in op9.training_sample(docs, "doc_id", "text", "lang").collect()}
    inside = {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert seen <= inside


# --- 10: benchmark

def brute_overlaps(docs, items):
    out = set()
    for d, t in docs:
        a = (t or "").lower().split()
        for i, u in items:
            b = (u or "").lower().split()
            width = min(20, len(b))
            if width < 9:
                continue
            for g in range(-len(b) + 1, len(a)):
                e = [0 <= k + g < len(a) and a[k + g] == w for k, w in enumerate(b)]
                if any(100 * sum(e[k:k + width]) >= 80 * width for k in range(len(b) - width + 1)):
                    out.add((d, i))
    return out


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_overlaps(spark, odd_rows, monkeypatch, limit):
    monkeypatch.setattr(op10, "BROADCAST_SEEDS", limit)
    rng = random.Random(6)
    items = [(1, prose(rng, 30)), (2, prose(rng, 12)), (3, "too short"), (4, None), (None, prose(rng, 25))]
    w = items[0][1].split()
    burst = w[:8] + ["x", "y", "z"] + w[11:]
    docs = [r for r in odd_rows if r[0] not in (1, 6, 7, None)]
    docs += [(20, prose(rng, 50) + " " + items[0][1].upper() + " " + prose(rng, 9)),
             (21, prose(rng, 20) + " " + " ".join(burst)), (22, " ".join(w[:10]) + " " + prose(rng, 40)),
             (23, prose(rng, 40)), (24, items[1][1]), (25, items[4][1] + " " + items[0][1]),
             (26, " ".join(x if k % 7 else "q" for k, x in enumerate(w)))]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, doc_id int")
    got = rows(op10.overlaps(frame(spark, docs), bench))
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute_overlaps(docs, items)
    assert len(got) == 6 and {r["diagonal"] for r in got if r["doc_id"] == 20} == {50}
    left = op10.decontaminate(frame(spark, docs), bench)
    assert left.columns == frame(spark, docs).columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {20, 21, 24, 25, 26}
    odd = op10.decontaminate(frame(spark, odd_rows), bench)
    assert odd.count() == len(odd_rows)
    assert op10.overlaps(frame(spark, docs).limit(0), bench).count() == 0
    assert op10.decontaminate(frame(spark, docs), bench.limit(0)).count() == len(docs)


def test_every_placement_of_replaced_words_leaves_a_seed():
    """The masks ignore words between the places they look at, and are complete."""
    assert all(mask[-1] + 1 > len(mask) for mask in op10.MASKS)
    for width in range(op10.SHORTEST, op10.WINDOW + 1):
        differ = max(r for r in range(width) if 100 * (width - r) >= op10.PCT * width)
        fewest = width
        for gone in itertools.combinations(range(width), differ):
            left = [at for mask in op10.MASKS for at in range(width - mask[-1])
                    if not any(at + o in gone for o in mask)]
            fewest = min(fewest, len(left))
        assert fewest == op10.fewest_hits(width) >= 1


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_short_items_are_matched_whole(spark, monkeypatch, limit):
    monkeypatch.setattr(op10, "BROADCAST_SEEDS", limit)
    monkeypatch.setattr(op10, "BROADCAST_IDS", limit)
    items = [(1, "one"), (2, "a b"), (3, "c d e f g h i j"), (4, "k l m n o p q r s"), (5, "")]
    docs = [(1, "ONE"), (2, "x a b"), (3, "a x b"), (4, "z c d e f g h i j z"), (5, "c d e f x h i j"),
            (6, "k l m n o p q r x"), (7, "k l m n x p q x s"), (8, None), (9, "b a one a b")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in op10.overlaps(frame(spark, docs), bench).collect()}
    assert got == {(1, 1), (2, 2), (4, 3), (6, 4), (9, 1), (9, 2)}


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_overlaps_at_every_placement(spark, monkeypatch, limit):
    monkeypatch.setattr(op10, "BROADCAST_SEEDS", limit)
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in (9, 10, 11, 15, 20, 33)]
    docs = []
    for n, text in items:
        width = min(n, 20)
        differ = max(r for r in range(width) if 100 * (width - r) >= 80 * width)
        for r in (differ, differ + 1):
            places = list(itertools.combinations(range(width), r))
            for gone in random.Random(n).sample(places, min(len(places), 400)):
                w = ["other" if k in gone else x for k, x in enumerate(text.split()[:width])]
                docs.append((len(docs), "before it " + " ".join(w) + " after"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in op10.overlaps(frame(spark, docs), bench).collect()}
    assert got == brute_overlaps(docs, items)
