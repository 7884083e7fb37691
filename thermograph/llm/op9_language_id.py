"""Language identification of words by a linear-chain conditional random field.

Words are runs of letters (ASCII letters lower-cased, and all bytes of other
characters).  A word's features are hashed: the word itself (lexicon), affixes
of 2 to 4 bytes, and all 3-grams of bytes with its ends marked.  The chain has a
label per learned language and learned transitions, so words of a code-switched
text are labelled by forward-backward; a document's language is the label with
the largest share of its words' marginals, and that share is its score.

*Training* uses a bounded sample, ``TRAIN_DOCS`` documents per language (those
with the smallest hashed ids; texts of up to ``TRAIN_CHARS`` characters), taken
from documents whose ``crc32(id as text) % 4`` is not 2.  Their words are cut
into pieces of several lengths and dealt into sequences that switch languages,
so that transitions are learned from switches too; gradients are exact
(forward-backward), steps are Adagrad's.  The model has a fixed size
(``BUCKETS`` weights per language) and is broadcast.

*Prediction* covers every word of every text, many texts at once: sequences are
cut into segments whose transfer matrices are computed side by side and then
chained, which gives the exact marginals of the whole text.  Nothing is
shuffled.

Nulls: a null text, or one without letters, is ``und`` with score 0; a null id
is not held out and never learned from.  Ties go to the first language by name.
Repeated rows get equal predictions.  Without any labelled text, all is
``und``.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermograph.llm._text import U64, Words, mix, powers, text_slices

BUCKETS = 1 << 18
TRAIN_DOCS = 250
TRAIN_CHARS = 20_000
EPOCHS = 6
SEGMENT = 128

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x80:] = np.arange(0x80, 256)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_MARK = U64(0x1F)


def split(texts: pa.Array) -> Words:
    return Words(texts, table=_LETTERS)


def features(words: Words, chosen: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, first feature of each word) of the words chosen."""
    start, size = words.start[chosen], (words.end - words.start)[chosen]
    out, of = [mix(hashes[chosen])], [np.arange(len(chosen))]
    buf = words.buf.astype(U64)
    q = powers(8, U64(0x9FB21C651E98DF25))
    for n in (2, 3, 4):
        at = np.flatnonzero(size >= n)
        for salt, begin in ((2 * n, start[at]), (2 * n + 1, start[at] + size[at] - n)):
            h = np.full(len(at), salt, U64) * q[5]
            for j in range(n):
                h += (buf[begin + j] + U64(1)) * q[j]
            out.append(mix(h))
            of.append(at)
    # 3-grams over the word with a mark before and after it: one per byte.
    of_byte = np.repeat(np.arange(len(chosen)), size)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    place = np.repeat(start, size) + inside
    before = np.where(inside > 0, buf[np.maximum(place - 1, 0)], _MARK)
    after = np.where(inside < size[of_byte] - 1, buf[np.minimum(place + 1, len(buf) - 1)], _MARK)
    out.append(mix(before * q[0] + buf[place] * q[1] + after * q[2] + q[6]))
    of.append(of_byte)
    of_all = np.concatenate(of)
    order = np.argsort(of_all, kind="stable")
    bucket = (np.concatenate(out) & U64(BUCKETS - 1)).astype(np.int32)[order]
    return bucket, np.searchsorted(of_all[order], np.arange(len(chosen)))


def emissions(bucket: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Summed weights of each word: one row per word, one column per label."""
    if not len(first):
        return np.zeros((0, weights.shape[1]), weights.dtype)
    return np.add.reduceat(weights[bucket], first, axis=0)


def segments(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences of ``count`` items cut into segments: (sequence, first item,
    items) of each, in order."""
    n = -(-count // SEGMENT)
    seq = np.repeat(np.arange(len(count)), n)
    k = np.arange(len(seq)) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(np.cumsum(count) - count, n) + k * SEGMENT
    return seq, begin, np.minimum(SEGMENT, count[seq] - k * SEGMENT)


def marginals(emit: np.ndarray, count: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Posterior of each item's label; ``emit``: the sequences' scores one after
    another.  With ``pairs`` also the expected counts of transitions.

    In a segment all forward (backward) vectors are multiples of its transfer
    matrices, which need no neighbour; boundaries are chained afterwards."""
    labels = len(trans)
    seq, begin, size = segments(count)
    m = len(seq)
    if not m:
        return (np.zeros_like(emit), np.zeros((labels, labels))) if pairs else np.zeros_like(emit)
    steps = int(size.max())
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    a = np.exp(trans - trans.max())
    order = np.argsort(-size, kind="stable")  # long ones first: live ones are a prefix
    begin_o, size_o = begin[order], size[order]
    live = np.searchsorted(-size_o, -np.arange(steps), side="left")
    first = np.zeros(m, bool)
    first[np.concatenate(([True], seq[1:] != seq[:-1]))] = True
    eye = np.eye(labels)
    # Forward: P[s, t] maps the vector before the segment to the one at t.
    fwd = np.zeros((steps, m, labels, labels), np.float32)
    now = np.broadcast_to(eye, (m, labels, labels)).copy()
    head = first[order]
    for t in range(steps):
        n = live[t]
        x = now[:n]
        y = (x.reshape(-1, labels) @ a).reshape(n, labels, labels)
        if t == 0:
            y[head[:n]] = x[head[:n]]  # a sequence begins without a transition
        y *= e[begin_o[:n] + t][:, None, :]
        y /= y.max(axis=(1, 2), keepdims=True)
        fwd[t, :n] = y
        now[:n] = y
    # Backward: Q maps the vector after the segment to the one at t (transposed).
    bwd = np.zeros((steps, m, labels, labels), np.float32)
    now = np.zeros((m, labels, labels))
    ends = np.ones(m, bool)
    ends[:-1] = seq[1:] != seq[:-1]
    tail = ends[order]
    for t in range(steps - 1, -1, -1):
        n = live[t]
        fresh = size_o[:n] == t + 1
        x = now[:n]
        if t + 1 < steps:
            k = live[t + 1]
            y = ((x[:k] * e[begin_o[:k] + t + 1][:, None, :]).reshape(-1, labels) @ a.T
                 ).reshape(k, labels, labels)
            y /= np.maximum(y.max(axis=(1, 2), keepdims=True), 1e-300)
            x[:k] = y
        x[fresh] = eye
        bwd[t, :n] = x
    # Chain the segments of a sequence, all sequences side by side.
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    level = np.arange(m) - np.maximum.accumulate(np.where(first, np.arange(m), 0))
    alpha, beta = np.ones((m, labels)), np.ones((m, labels))
    by_level = [np.flatnonzero(level == k) for k in range(int(level.max()) + 1)]
    for k in range(1, len(by_level)):
        s = by_level[k]
        p = place[s - 1]
        v = np.einsum("nl,nlj->nj", alpha[s - 1], fwd[size[s - 1] - 1, p])
        alpha[s] = v / v.sum(axis=1, keepdims=True)
    for k in range(len(by_level) - 2, -1, -1):
        s = by_level[k][~ends[by_level[k]]]
        if not len(s):
            continue
        p = place[s + 1]
        v = np.einsum("nl,nlj->nj", beta[s + 1], bwd[0, p])  # at the next segment's first item
        v = (v * e[begin[s + 1]]) @ a.T
        beta[s] = v / v.sum(axis=1, keepdims=True)
    del tail
    af = np.einsum("nl,tnlj->tnj", alpha[order], fwd)
    bf = np.einsum("nl,tnlj->tnj", beta[order], bwd)
    t_of = np.repeat(np.arange(steps), live)
    s_of = np.concatenate([np.arange(n) for n in live])
    item = begin_o[s_of] + t_of
    f, b = np.zeros(emit.shape), np.zeros(emit.shape)
    f[item], b[item] = af[t_of, s_of], bf[t_of, s_of]
    post = f * b
    post /= post.sum(axis=1, keepdims=True)
    if not pairs:
        return post
    inner = np.ones(len(emit), bool)
    inner[np.cumsum(count)[count > 0] - 1] = False
    at = np.flatnonzero(inner)
    right = e[at + 1] * b[at + 1]
    z = np.einsum("nl,lj,nj->n", f[at], a, right)
    expected = np.einsum("nl,nj->lj", f[at] / z[:, None], right) * a
    return post, expected


class Model:
    def __init__(self, labels: list[str]):
        self.labels = labels
        self.weights = np.zeros((BUCKETS, len(labels)), np.float32)
        self.trans = np.zeros((len(labels), len(labels)))


def train(texts: list[str], langs: list[str], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """A chain fitted to whole labelled texts."""
    model = Model(sorted(set(langs)))
    if not model.labels:
        return model
    number = {lang: i for i, lang in enumerate(model.labels)}
    words = split(pa.array(texts, pa.large_string()))
    hashes = words.hashes()
    if not len(hashes):
        return model
    distinct, kind = np.unique(hashes, return_inverse=True)
    some = np.zeros(len(distinct), np.int64)
    some[kind] = np.arange(len(hashes))
    bucket, first = features(words, some, hashes)
    size = np.diff(first, append=len(bucket))
    of = np.repeat(np.arange(len(distinct)), size)
    truth = np.array([number[x] for x in langs])[words.doc]
    rng = np.random.default_rng(seed)
    labels = len(model.labels)
    g_w, g_t = np.full(model.weights.shape, 1e-2, np.float32), np.full(model.trans.shape, 1.0)
    for _ in range(epochs):
        # Pieces of 5 to 60 words of one text, dealt into sequences of several.
        cuts = np.cumsum(rng.integers(5, 60, len(hashes) // 5 + 1))
        edges = np.unique(np.concatenate((words.first[:-1], cuts[cuts < len(hashes)])))
        edges = edges[edges < len(hashes)]
        length = np.diff(edges, append=len(hashes))
        deal = rng.permutation(len(edges))
        for part in np.array_split(deal, max(1, len(deal) // 2000)):
            n = length[part]
            items = np.repeat(edges[part], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            ends = np.cumsum(n)[rng.integers(2, 6) - 1::4]
            count = np.diff(np.unique(np.concatenate(([0], ends, [len(items)]))))
            own = kind[items]
            emit = emissions(bucket, first, model.weights)[own].astype(np.float64)
            post, expected = marginals(emit, count, model.trans, True)
            y = truth[items]
            gap = -post
            gap[np.arange(len(y)), y] += 1
            inner = np.ones(len(y), bool)
            inner[np.cumsum(count) - 1] = False
            at = np.flatnonzero(inner)
            seen = np.zeros_like(expected)
            np.add.at(seen, (y[at], y[at + 1]), 1)
            step = seen - expected - 1e-3 * model.trans
            g_t += step ** 2
            model.trans += 0.5 * step / np.sqrt(g_t)
            word_gap = np.stack([np.bincount(own, gap[:, k], len(distinct)) for k in range(labels)], 1)
            grad = np.stack([np.bincount(bucket, word_gap[of, k], BUCKETS) for k in range(labels)], 1)
            grad = (grad - 1e-4 * model.weights).astype(np.float32)
            g_w += grad ** 2
            model.weights += 0.1 * grad / np.sqrt(g_w)
    return model


def predict(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(label number or -1, score) of each text."""
    n = len(texts)
    label, score = np.full(n, -1), np.zeros(n)
    words = split(texts)
    hashes = words.hashes()
    if not len(hashes) or not model.labels:
        return label, score
    distinct, some, kind = np.unique(hashes, return_index=True, return_inverse=True)
    bucket, first = features(words, some, hashes)
    emit = emissions(bucket, first, model.weights)[kind]
    count = np.diff(words.first)
    post = marginals(emit, count, model.trans)
    full = np.flatnonzero(count)
    total = np.add.reduceat(post, words.first[full], axis=0)
    label[full] = total.argmax(axis=1)
    score[full] = np.clip(total.max(axis=1) / count[full], 0.0, 1.0)
    # Bytes of other characters need not be letters.
    ascii_letter = np.concatenate(([0], np.cumsum((words.buf >= 0x61) & (words.buf <= 0x7A))))
    bare = full[ascii_letter[words.off[full + 1]] == ascii_letter[words.off[full]]]
    for at in bare.tolist():
        if not any(c.isalpha() for c in texts[at].as_py()):
            label[at], score[at] = -1, 0.0
    return label, score


def _held_out(column):
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """At most ``TRAIN_DOCS`` (text, lang) per language, none of them held out."""
    h = F.xxhash64(F.col(id_col).cast("string"))
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull()
                      & ~_held_out(F.col(id_col)) & (F.length(text_col) <= TRAIN_CHARS))
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       F.shiftrightunsigned(h, 1).alias("h"))
    # A hash threshold per language leaves little more than the sample to rank.
    sizes = rows.groupBy("lang").count()
    rows = rows.join(F.broadcast(sizes), "lang").where(
        F.col("h") / F.lit(float(1 << 63)) <= F.lit(2.0 * TRAIN_DOCS) / F.col("count"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return rows.withColumn("r", rank).where(F.col("r") <= TRAIN_DOCS).select("text", "lang")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """A model from the labelled documents that aren't held out."""
    rows = training_sample(docs, id_col, text_col, lang_col).collect()
    rows = sorted((r["lang"], r["text"]) for r in rows)
    return train([t for _, t in rows], [lang for lang, _ in rows])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*sent.value.labels, "und"], dtype=object)
        for batch in batches:
            for i, j, texts in text_slices(batch.column("_text"), 4 << 20):
                label, score = predict(texts, sent.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(i, j - i), pa.array(names[label], pa.string()),
                     pa.array(score)], ["_id", "lang_pred", "score"])
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, lang_pred string, score double"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, fit(docs))
    return out.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
