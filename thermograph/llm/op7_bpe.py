"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Encoding, for texts of any number and length:

1. Texts are split into pre-tokens with their positions.  A task gathers
   consecutive documents into *chunks* of about ``CHUNK_WORDS`` pre-tokens and
   numbers the distinct words of a chunk: the positions of a document become a
   list of those numbers, so a word travels once per chunk, not per occurrence.
2. Words are shuffled by word: by a hash into buckets, a chunk's words of one
   bucket packed into a row.  All occurrences of a word meet, and each distinct
   word of the whole input is merged once.  A word comes at most once per
   chunk, so no word is a hot key.
3. The ids go back to the chunk, join its documents there, and are put
   together by position.

Decoding looks each id up in the token-byte table, a map-side join: the table
has one row per id of the vocabulary (at most ``MAX_VOCABULARY``, checked).

A chunk's name is a hash of all its words in their order (chunks with the same
list share a name and its ids).  The documents are read once for the words and
once for the positions; if the second reading gave other chunks, names would
not meet and the job stops with an error.

Nulls: a null text is an empty one: no ids, no bytes.  Null and repeated ids
are kept, one row per input row.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_WORDS = 1_000_000
MAX_VOCABULARY = 1 << 20
OUT_BYTES = 1 << 20  # of ids in one Arrow batch


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a vocabulary file (base64 token and rank per line)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} tokens; at most {MAX_VOCABULARY} are sent to each task")
    return ranks


def other_characters() -> dict[int, str]:
    """Characters that the ``regex`` module and tiktoken put into different
    classes (their Unicode versions differ), with a stand-in for each that
    both see as tiktoken sees the character."""
    import regex
    import tiktoken
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    out: dict[int, str] = {}
    theirs, ours = {}, {}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        found = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks=single,
                                  special_tokens={}).encode_ordinary(every)
        theirs[kind] = set(bytes(found).decode())
        ours[kind] = set(regex.findall(kind, every))
    for kind in theirs:
        for c in theirs[kind] ^ ours[kind]:
            out[ord(c)] = "\u00df" if c in theirs[r"\p{L}"] else "\u00b2" \
                if c in theirs[r"\p{N}"] else "\u2003" if c in theirs[r"\s"] else "\u2402"
    return out


def splitter(pattern: str, other: dict[int, str]) -> Callable[[str], list[str]]:
    """Pre-tokens of a text, as tiktoken splits it."""
    import regex
    compiled = regex.compile(pattern)
    odd = set(map(chr, other))

    def split(text: str) -> list[str]:
        if text.isascii() or odd.isdisjoint(text):
            return compiled.findall(text)
        return [text[m.start():m.end()] for m in compiled.finditer(text.translate(other))]
    return split


def _pack(*parts: np.ndarray | bytes) -> bytes:
    """Numbers below 2**32 (byte planes apart) and bytes as one compressed blob."""
    import zstandard
    out = []
    for part in parts:
        if not isinstance(part, bytes):
            part = part.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
        out += [len(part).to_bytes(8, "little"), part]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(blob: bytes, numbers: int) -> list:
    """The parts of a blob, the first ``numbers`` of them as numbers."""
    import zstandard
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        end = at + 8 + int.from_bytes(data[at:at + 8], "little")
        part, at = data[at + 8:end], end
        if len(out) < numbers:
            planes = np.frombuffer(part, np.uint8).reshape(4, -1)
            part = np.ascontiguousarray(planes.T).view("<u4").ravel()
        out.append(part)
    return out


def _chunks(batches: Iterator[pa.RecordBatch], pattern: str, other, packed: bool):
    """(name, ids, blobs, words) of each chunk of a task's documents."""
    split = splitter(pattern, other.value)
    words: defaultdict = defaultdict()
    words.default_factory = words.__len__
    ids: list = []
    blobs: list = []
    held = 0

    def name() -> int:
        digest = hashlib.blake2b("\0".join(words).encode(), digest_size=8).digest()
        return int.from_bytes(digest, "little", signed=True)

    for batch in batches:
        column = batch.column("_id")
        for at, text in enumerate(batch.column("_text")):
            found = split(text.as_py() or "")
            slots = list(map(words.__getitem__, found))
            if packed:
                blobs.append(_pack(np.array(slots, np.uint32)))
                ids.append(column[at])
            held += max(len(found), 1)
            if held >= CHUNK_WORDS:
                yield name(), ids, blobs, words
                words.clear()
                ids, blobs, held = [], [], 0
    if held:
        yield name(), ids, blobs, words
    pa.default_memory_pool().release_unused()


def _words(pattern: str, other, buckets: int):
    """Distinct words of each chunk, one row for each bucket of words."""
    def run(batches):
        for chunk, _, _, words in _chunks(batches, pattern, other, False):
            data = [w.encode() for w in words]
            bucket = np.fromiter(map(zlib.crc32, data), np.int64, len(data)) % buckets
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order])) + 1
            rows = [own for own in np.split(order, cut) if len(own)]
            blobs = []
            for own in rows:
                mine = [data[k] for k in own.tolist()]
                blobs.append(_pack(own, np.fromiter(map(len, mine), np.int64, len(mine)),
                                   b"".join(mine)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), chunk, np.int64)),
                 pa.array([int(bucket[own[0]]) for own in rows], pa.int32()),
                 pa.array(blobs, pa.binary())], ["chunk", "bucket", "words"])
    return run


def _positions(pattern: str, other, id_type: pa.DataType):
    def run(batches):
        for chunk, ids, blobs, words in _chunks(batches, pattern, other, True):
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, chunk, np.int64)),
                 pa.array(np.full(n, len(words), np.int32)),
                 pa.array([x.as_py() for x in ids], id_type), pa.array(blobs, pa.binary())],
                ["chunk", "n_words", "_id", "blob"])
    return run


def _merge(ranks):
    """ids of the words; rows are sorted by bucket, and a word has one bucket, so
    each distinct word is merged once."""
    def run(batches):
        import tiktoken
        # One pattern match is the whole piece: it has been split already.
        merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks.value,
                                  special_tokens={}).encode_ordinary
        known: dict[bytes, list[int]] = {}
        last = None
        for batch in batches:
            out = []
            for bucket, blob in zip(batch.column("bucket").to_pylist(),
                                    batch.column("words").to_pylist(), strict=True):
                if bucket != last:
                    known, last = {}, bucket
                slots, size, data = _unpack(blob, 2)
                ids, n, at = [], [], 0
                for end in np.cumsum(size, dtype=np.int64).tolist():
                    word = data[at:end]
                    own = known.get(word)
                    if own is None:
                        own = known[word] = merge(word.decode())
                    ids += own
                    n.append(len(own))
                    at = end
                out.append(_pack(slots, np.array(n, np.uint32), np.array(ids, np.uint32)))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(out, pa.binary())],
                                             ["chunk", "ids"])
    return run


def _assemble(finish: Callable | None, id_type: pa.DataType):
    """Documents' ids from rows sorted by (chunk, kind): words, then documents."""
    def parts(batches):
        chunk, held, table = None, [], None
        for batch in batches:
            names = batch.column("chunk").to_numpy()
            cut = np.flatnonzero(names[1:] != names[:-1]) + 1
            for i, j in zip([0, *cut], [*cut, len(names)], strict=True):
                if j == i:
                    continue
                if names[i] != chunk:
                    chunk, held, table = names[i], [], None
                rows = batch.slice(i, j - i)
                w = int((rows.column("kind").to_numpy() == 0).sum())
                held += [_unpack(x, 3) for x in rows.column("data").slice(0, w).to_pylist()]
                if w == len(rows):
                    continue
                docs = rows.slice(w)
                if table is None:
                    slots, size, flat = (np.concatenate([x[k] for x in held]) if held
                                         else np.zeros(0, np.uint32) for k in range(3))
                    # Chunks with the same words have the same name, and rows twice.
                    _, order = np.unique(slots, return_index=True)
                    size = size.astype(np.int64)
                    table = (np.cumsum(size) - size)[order], size[order], flat.astype(np.int32)
                    held = []
                begin, size, flat = table
                if len(size) != docs.column("n_words")[0].as_py():
                    raise RuntimeError("the documents changed between the two readings")
                # A few documents at a time, whole ones.
                got, first, total = [], 0, 0
                blobs = docs.column("data").to_pylist()
                for at, blob in enumerate(blobs):
                    s = _unpack(blob, 1)[0]
                    n = size[s]
                    ends = np.cumsum(n)
                    here = int(ends[-1]) if len(n) else 0
                    got.append(flat[np.arange(here) + np.repeat(begin[s] - (ends - n), n)])
                    total += 4 * here
                    if total >= OUT_BYTES or at == len(blobs) - 1:
                        offsets = np.concatenate(([0], np.cumsum([len(x) for x in got])))
                        lists = pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()), pa.array(np.concatenate(got)))
                        yield pa.RecordBatch.from_arrays(
                            [docs.column("_id").slice(first, len(got)), lists], ["_id", "ids"])
                        got, first, total = [], at + 1, 0

    def run(batches):
        out = parts(batches)
        yield from finish(out) if finish else out
        pa.default_memory_pool().release_unused()
    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text", finish: Callable | None = None,
           finish_schema: str | None = None) -> DataFrame:
    """``id_col`` and ids (array of int) of every document.  ``finish`` may map
    the Arrow batches (_id, ids) on to other columns in the same task."""
    sc = docs.sparkSession.sparkContext
    table, other = sc.broadcast(ranks), sc.broadcast(other_characters())
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema["_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow, name = to_arrow_type(kind), kind.simpleString()
    # More buckets than tasks, so that a task holds a share of the distinct words.
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = docs.mapInArrow(_words(pattern, other, buckets), "chunk long, bucket int, words binary")
    ids = (words.repartition("bucket").sortWithinPartitions("bucket")
           .mapInArrow(_merge(table), "chunk long, ids binary"))
    places = docs.mapInArrow(_positions(pattern, other, arrow),
                             f"chunk long, n_words int, _id {name}, blob binary")
    both = ids.select("chunk", F.lit(0).alias("kind"), F.lit(0).alias("n_words"),
                      F.lit(None).cast(kind).alias("_id"), F.col("ids").alias("data")).unionByName(
        places.select("chunk", F.lit(1).alias("kind"), "n_words", "_id",
                      F.col("blob").alias("data")))
    both = both.repartition("chunk").sortWithinPartitions("chunk", "kind")
    out = both.mapInArrow(_assemble(finish, arrow), finish_schema or f"_id {name}, ids array<int>")
    return out.withColumnRenamed("_id", id_col)


def byte_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each id, all tokens' bytes); an id without a token has none."""
    tokens = {v: k for k, v in ranks.items()}
    top = max(tokens, default=-1) + 1
    size = np.array([len(tokens.get(i, b"")) for i in range(top)], np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    flat = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(top)), np.uint8)
    return begin, flat


def decode_batches(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    """Adds ``decoded`` (binary) to batches that have ``ids``."""
    begin, flat = table
    size = np.diff(begin)
    for batch in batches:
        lists = batch.column("ids")
        ids = lists.flatten().to_numpy()
        edge = np.concatenate(([0], np.cumsum(pa.compute.fill_null(
            pa.compute.list_value_length(lists), 0).to_numpy()))).astype(np.int64)
        n = size[ids]
        ends = np.concatenate(([0], np.cumsum(n)))
        take = np.arange(ends[-1]) + np.repeat(begin[ids] - ends[:-1], n)
        data = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(batch),
            [None, pa.py_buffer(ends[edge].astype(np.int64)), pa.py_buffer(flat[take])])
        yield pa.RecordBatch.from_arrays([*batch.columns, data], [*batch.schema.names, "decoded"])


def decode(df: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``decoded`` (binary) for rows of ids; null ids: empty."""
    table = df.sparkSession.sparkContext.broadcast(byte_table(ranks))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in decode_batches(batches, table.value):
            yield batch.select(["_id", "decoded"]).cast(
                pa.schema([batch.schema.field("_id"), pa.field("decoded", pa.binary())]))
    rows = df.select(F.col(id_col).alias("_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"_id {kind}, decoded binary").withColumnRenamed("_id", id_col)


def _digests(table):
    def run(batches):
        decimal = [str(i) for i in range(len(table.value[0]) - 1)]
        for batch in decode_batches(batches, table.value):
            ids = batch.column("ids")
            edge = ids.offsets.to_numpy()
            flat = ids.values.to_numpy().tolist()
            shas = []
            for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                shas.append(hashlib.sha256(
                    ",".join(map(decimal.__getitem__, flat[i:j])).encode()).hexdigest())
            back = [hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("decoded")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(np.diff(edge).astype(np.int64)), pa.array(shas),
                 pa.array(back)], ["_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def bpe_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 with the public vocabulary."""
    import public_tokenizers
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    table = docs.sparkSession.sparkContext.broadcast(byte_table(ranks))
    kind = docs.schema[id_col].dataType.simpleString()
    return encode(docs, ranks, public_tokenizers.PATTERN, id_col, text_col, _digests(table),
                  f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of all ``documents``, as digests."""
    return bpe_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
