"""Secret scan: fixed patterns, and a randomness test battery for the rest.

Patterns (leftmost, non-overlapping per kind): ``assign``, a key word, ``=`` or
``:`` and a value of 12 or more characters; ``access``, ``AKIA`` and 18 or more
characters in all; ``hex``, 16 or more lower-case hexadecimal digits.

The battery takes every maximal run of ``A-Za-z0-9+/_-`` of 20 or more
characters that has digits and letters, or letters alone, and infers its
encoding: the smallest of the letters of one case, of both, hexadecimal, base
32, base 36 and base 64 whose alphabet holds it.

* *Is it uniform?*  Chi-squared over bins of the alphabet (5 or more characters
  expected in each), a runs test about the middle of the alphabet and the lag-1
  serial correlation.  A run that is rejected by one of them at
  ``REJECT / 3`` is no secret.
* *Could it be text?*  Chi-squared against the shares of common letters, other
  letters, digits and signs in identifiers; the number of changes between
  character classes against a binomial that changes as seldom as names do; the
  number of neighbouring letters that words often put side by side against a
  binomial with the share that names have.  The p-values are combined by
  Fisher's method.  They fall with the length.
* *False discoveries.*  Benjamini-Hochberg over the runs of a document at
  ``FDR``, each p-value divided by a weight in proportion to the run's length,
  as long runs carry more evidence; weights average one.

What passes and lies in no pattern's span is added as kind ``random``.

Every decision uses one text only, so no row moves; only texts that contain a
key word, ``AKIA`` or a long run (found on numpy arrays over many texts) are
looked at one by one.

Nulls: a null text is an empty one, without spans.  Null and repeated ids are
kept, one row per input row.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.llm._text import text_slices

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
CAPITAL = re.compile("(?:^|(?<=[ld]))u(?=l)")
KINDS = ("assign", "access", "hex", "random")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

FDR = 0.001
REJECT = 0.003
MIN_RUN = 20
DIGITS = "0123456789"
LOW = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "low": LOW, "up": LOW.upper(), "letters": LOW.upper() + LOW,
    "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "base32": LOW.upper() + "234567",
    "base36": DIGITS + LOW, "BASE36": DIGITS + LOW.upper(),
    "base64": LOW.upper() + LOW + DIGITS + "+/-_",
}
COMMON = frozenset("etaoinsrhlETAOINSRHL")
# Shares of common letters, other letters, digits and signs in identifiers, and
# how often neighbours there differ in class.
TEXT_SHARES = (0.60, 0.23, 0.11, 0.06)
TEXT_CHANGE = 0.2
# Pairs of letters that are frequent in words of European
# languages, and the least share of such pairs in names.
PAIRS = frozenset(
    "al am an ar as at be ca ce ch co ct de di do ea ed el en er es et ge ha he ic ie il in io is "
    "it la le li lo ma me na nd ne ng no ns nt om on or ou pe po pr ra re ri ro rt sa se si so ss "
    "st ta te th ti to tr un ur us ut ve vi".split())
TEXT_PAIRS = 0.48


def normal_tail(z: float) -> float:
    """P(|Z| >= z)."""
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_tail(x: float, df: int) -> float:
    """P(X >= x) of chi-squared, by the Wilson-Hilferty cube root."""
    if df <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X >= k)."""
    term = lambda i: math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                              + i * math.log(p) + (n - i) * math.log1p(-p))
    if k <= n * p:
        return 1.0
    total = now = term(k)
    for i in range(k + 1, n + 1):
        now *= (n - i + 1) / i * p / (1 - p)
        total += now
        if now < total * 1e-12:
            break
    return min(1.0, total)


def encoding(run: str) -> str | None:
    """The smallest alphabet that holds all characters of ``run``; none for runs
    of digits, and of words joined by signs alone."""
    used = set(run)
    if not used - set(DIGITS) or not used & set(DIGITS) and not run.isalpha():
        return None
    return next((name for name, a in ALPHABETS.items() if used <= set(a)), None)


def uniform_p(run: str, alphabet: str) -> float:
    """The smallest p-value of the three tests of uniformity."""
    n, k = len(run), len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place[c] for c in run])
    bins = max(2, min(k, n // 5))
    expected = n * np.bincount(np.arange(k) * bins // k, minlength=bins) / k
    found = np.bincount(x * bins // k, minlength=bins)
    p = chi2_tail(float(((found - expected) ** 2 / expected).sum()), bins - 1)
    high = x >= k / 2
    n1 = int(high.sum())
    n0 = n - n1
    if n0 and n1:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2 * n0 * n1 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        if var > 0:
            p = min(p, normal_tail((runs - mean) / math.sqrt(var)))
    d = x - x.mean()
    power = float((d * d).sum())
    if power > 0:
        r = float((d[1:] * d[:-1]).sum()) / power
        p = min(p, normal_tail((r + 1 / n) * math.sqrt(n)))
    return p


def text_p(run: str) -> float:
    """Fisher's combination of the tests against text."""
    n = len(run)
    kind = ["c" if c in COMMON else "o" if c.isalpha() else "d" if c.isdigit() else "s"
            for c in run]
    x = sum((kind.count(k) - n * q) ** 2 / (n * q)
            for k, q in zip("cods", TEXT_SHARES, strict=True))
    # Signs join the words of a name, so they aren't a class of their own here.
    case = ["u" if c.isupper() else "l" if c.islower() else "d" for c in run if c.isalnum()]
    changes = sum(a != b for a, b in zip(case[1:], case, strict=False))
    # A capital that begins a lower-case word is one change, not two.
    changes -= len(CAPITAL.findall("".join(case)))
    low = run.lower()
    pairs = [x + y in PAIRS for x, y in zip(low, low[1:], strict=False) if x.isalpha() and y.isalpha()]
    tails = (chi2_tail(x, len(TEXT_SHARES) - 1),
             binomial_tail(changes, max(len(case) - 1, 0), TEXT_CHANGE),
             binomial_tail(len(pairs) - sum(pairs), len(pairs), 1 - TEXT_PAIRS))
    log = -sum(math.log(max(p, 1e-100)) for p in tails)
    return min(1.0, math.exp(-log) * sum(log ** i / math.factorial(i) for i in range(len(tails))))


def random_spans(text: str) -> list[tuple[int, int]]:
    """Runs of ``text`` that look random, false discoveries controlled."""
    tested = []
    for m in RUN.finditer(text):
        name = encoding(m[0])
        if name:
            tested.append((m.start(), m.end(), text_p(m[0]),
                           uniform_p(m[0], ALPHABETS[name])))
    if not tested:
        return []
    mean = sum(e - s for s, e, _, _ in tested) / len(tested)
    ranked = sorted((p * mean / (e - s), s, e, u) for s, e, p, u in tested)
    last = max((i for i, (q, *_) in enumerate(ranked, 1) if q <= FDR * i / len(ranked)), default=0)
    return sorted((s, e) for _, s, e, u in ranked[:last] if u >= REJECT / 3)


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, sorted; code points, end exclusive."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(spans)
    # The farthest end of the spans that begin up to each one.
    begins, ends = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
    for s, e in random_spans(text):
        at = bisect_right(begins, s)
        if not at or ends[at - 1] < e:
            spans.append((s, 3, e))
    return sorted(spans)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    hexa, run = np.zeros(256, bool), np.zeros(256, bool)
    hexa[list(b"0123456789abcdef")] = True
    run[list((DIGITS + LOW + LOW.upper() + "+/_-").encode())] = True
    return hexa, run


_HEX, _RUN = _classes()


def _long_runs(flags: np.ndarray, edges: np.ndarray, least: int) -> np.ndarray:
    """Begins of maximal runs of ``flags`` of at least ``least``, cut at edges."""
    wall = np.zeros(len(flags) + 1, bool)
    wall[edges] = True
    begin = flags.copy()
    begin[1:] &= ~flags[:-1] | wall[1:-1]
    end = flags.copy()
    end[:-1] &= ~flags[1:] | wall[1:-1]
    a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return a[b - a >= least]


def suspects(texts: pa.Array) -> np.ndarray:
    """Rows whose text may have a span; all others have none."""
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    if not len(raw):
        return np.zeros(0, np.int64)
    lower = raw.copy()
    lower[(raw >= 0x41) & (raw <= 0x5A)] += 32
    flat, at = lower.tobytes(), []
    for word in WORDS:
        k = flat.find(word)
        while k >= 0:
            at.append(k)
            k = flat.find(word, k + 1)
    flat = raw.tobytes()
    k = flat.find(b"AKIA")
    while k >= 0:
        at.append(k)
        k = flat.find(b"AKIA", k + 1)
    at += _long_runs(_HEX[raw], off, 16).tolist()
    at += _long_runs(_RUN[raw], off, MIN_RUN).tolist()
    return np.unique(np.searchsorted(off, np.array(at, np.int64), side="right") - 1)


_EMPTY = hashlib.sha256(b"").hexdigest()


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, texts in text_slices(batch.column("_text")):
            found: list[list] = [[] for _ in range(j - i)]
            for at in suspects(texts).tolist():
                found[at] = [{"kind": KINDS[k], "start": s, "end": e}
                             for s, k, e in scan(texts[at].as_py())]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                       ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").slice(i, j - i), pa.array(found, kind)], ["_id", "spans"])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and spans: array of (kind, start, end), by start, then kind."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = (f"_id {rows.schema['_id'].dataType.simpleString()}, "
              "spans array<struct<kind: string, start: bigint, end: bigint>>")
    return rows.mapInArrow(_run, schema).withColumnRenamed("_id", id_col)


def redact(docs: DataFrame, mark: str = "<secret>", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs`` with each span of ``text_col`` replaced by ``mark``; overlapping
    spans are replaced together.  A null text stays null."""
    def run(batches):
        for batch in batches:
            column = batch.schema.get_field_index(text_col)
            values = batch.column(column)
            out = values.to_pylist()
            for i, j, texts in text_slices(values):
                for at in suspects(texts).tolist():
                    text, end, parts = out[i + at], 0, []
                    for s, _, e in scan(text):
                        if s >= end:
                            parts += [text[end:s], mark]
                        end = max(end, e)
                    out[i + at] = "".join([*parts, text[end:]]) if parts else text
            yield batch.set_column(column, batch.schema.field(column), pa.array(out, values.type))
    return docs.mapInArrow(run, docs.schema)


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Spans of all ``documents``, counted and joined."""
    rows = secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"), count("random").alias("n_random"))
