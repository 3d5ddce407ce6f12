"""Substring dedup: repeated token windows by Rabin-Karp hashes.

A window is ``WINDOW`` consecutive words of one document. Its Rabin-Karp hash
is a polynomial in 64-bit word hashes modulo the prime 2^61 - 1. A window is
repeated if its words also start earlier: in a document with a smaller id, or
in the same document at an earlier word. All words that repeated windows cover
are removed; overlapping windows merge into maximal intervals.

Two windows count as equal if their 61-bit hashes are (for n windows, about
n^2 / 2^62 pairs of different windows collide in the whole corpus).

Three tasks, two shuffles:

1. Map: every window of a chunk of documents is hashed. Windows repeated inside
   the chunk are settled there; of every hash only the first window goes on, so
   a passage in a third of all rows leaves a chunk once. Windows are packed by
   hash bucket: the rest of the hash in 7 bytes, positions and ids as varints.
2. Per hash bucket: all but the first window of every hash are marked, and the
   marks are packed by document bucket. The text does not take part.
3. Per document bucket: marks meet the texts, intervals are cut out.

Buckets are hashes, so they are even; their number follows
``spark.sql.shuffle.partitions`` (raise that with the data: a bucket of 2
million windows takes about 100 MB in a task).

Defined results: NULL text has no words and an empty result; texts shorter than
a window stay whole; NULL ids come after all others, as one document; rows that
share id and text are one document and lose the same words; rows that share only
the id count as one document in "starts earlier", their words are removed
apart; an empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
CHUNK_BYTES = 6_000_000
NULL_ID = np.iinfo(np.int64).max

_P = np.uint64((1 << 61) - 1)
_BASE = 1_162_261_467_311_317_009 % int(_P)
_U = np.uint64
PACKED = "bucket int, h binary, d binary, t binary, c binary, p binary"
_MARKS = pa.schema([("bucket", pa.int32()), *[(x, pa.binary()) for x in "hdtcp"]])


# --- numbers ---------------------------------------------------------------

def _mod(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: int) -> np.ndarray:
    """a * b modulo 2^61 - 1, in 32-bit halves of b and 29-bit parts of a."""
    b1, b0 = _U(b >> 31), _U(b & 0x7FFFFFFF)
    a1, a0 = a >> _U(31), a & _U(0x7FFFFFFF)
    mid = _mod(a1 * b0 + a0 * b1)                      # times 2^31
    return _mod(_mod(a1 * b1 * _U(2)) + (mid >> _U(30)) + ((mid & _U(0x3FFFFFFF)) << _U(31))
                + _mod(a0 * b0))


def window_hashes(word_hashes: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Rabin-Karp hashes of all windows of ``size`` words, by doubling:
    H(2k)[i] = H(k)[i] * B^k + H(k)[i + k]."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, width = _mod(word_hashes.astype(np.uint64)), 1
    acc, done = None, 0
    left = size
    while left:
        if left & 1:  # append the block of this width behind what is done
            acc, done = (power, width) if acc is None else (_join(power, width, acc, done), done + width)
        left >>= 1
        if left:
            power, width = _join(power, width, power, width), width * 2
    return acc[:n]


def _join(a: np.ndarray, wa: int, b: np.ndarray, wb: int) -> np.ndarray:
    """Hashes of windows made of a window of ``a`` and the one of ``b`` after it."""
    m = min(len(a), len(b) - wa)
    return _mod(_times(a[:m], pow(_BASE, wb, int(_P))) + b[wa:wa + m])


def varint(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """LEB128 bytes of unsigned numbers, and where each number ends."""
    v = values.astype(np.uint64)
    n = np.ones(len(v), np.int64)
    rest = v >> _U(7)
    while rest.any():
        n += rest > 0
        rest >>= _U(7)
    ends = np.cumsum(n)
    out = np.empty(int(ends[-1]) if len(v) else 0, np.uint8)
    for k in range(int(n.max()) if len(v) else 0):
        sel = n > k
        out[(ends - n)[sel] + k] = ((v[sel] >> _U(7 * k)) & _U(127)).astype(np.uint8) | ((n[sel] > k + 1) << 7).astype(np.uint8)
    return out, ends


def unvarint(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.empty(0, np.uint64)
    ends = np.flatnonzero(b < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(b)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((b & 127).astype(np.uint64) << (place * 7).astype(np.uint64), starts)


def zigzag(x: np.ndarray) -> np.ndarray:
    return ((x << 1) ^ (x >> 63)).view(np.uint64)


def unzigzag(x: np.ndarray) -> np.ndarray:
    return (x >> _U(1)).view(np.int64) ^ -(x & _U(1)).view(np.int64)


# --- packed windows --------------------------------------------------------

def pack(bucket, doc, tag, pos, rest=None) -> list[tuple]:
    """Rows of ``PACKED`` from windows sorted by (bucket, doc, tag, pos):
    runs of one document hold its id (difference), tag and count; positions are
    differences inside a run. ``rest``: hashes without their bucket, 7 bytes."""
    n = len(bucket)
    if not n:
        return []
    new_bucket = np.r_[True, bucket[1:] != bucket[:-1]]
    new_run = new_bucket | np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]
    runs, firsts = np.flatnonzero(new_run), np.flatnonzero(new_bucket)
    gaps = np.where(new_run, pos, pos - np.r_[0, pos[:-1]])
    run_doc = doc[runs]
    with np.errstate(over="ignore"):
        ids = np.where(new_bucket[runs], run_doc, run_doc - np.r_[0, run_doc[:-1]])
    counts = np.diff(np.r_[runs, n])
    p, p_end = varint(gaps)
    d, d_end = varint(zigzag(ids))
    c, c_end = varint(counts)
    t = tag[runs].astype("<u4").view(np.uint8)
    h = np.empty(0, np.uint8) if rest is None else np.ascontiguousarray(
        rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).reshape(-1)
    stop = np.r_[firsts[1:], n]
    r0, r1 = np.searchsorted(runs, firsts), np.searchsorted(runs, stop)
    cut = lambda data, ends, a, b: data[(ends[a - 1] if a else 0):ends[b - 1]].tobytes()
    return [(int(bucket[a]), None if rest is None else h[7 * a:7 * b].tobytes(), cut(d, d_end, i, j),
             t[4 * i:4 * j].tobytes(), cut(c, c_end, i, j), cut(p, p_end, a, b))
            for a, b, i, j in zip(firsts.tolist(), stop.tolist(), r0.tolist(), r1.tolist())]


def unpack(d: bytes, t: bytes, c: bytes, p: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, tag, pos) of the windows of one packed row."""
    with np.errstate(over="ignore"):
        doc = np.cumsum(unzigzag(unvarint(d)))
    counts = unvarint(c).astype(np.int64)
    gaps = unvarint(p).astype(np.int64)
    run = np.repeat(np.arange(len(counts)), counts)
    total = np.cumsum(gaps)
    start = np.cumsum(counts) - counts
    pos = total - (total[start] - gaps[start])[run]
    return doc[run], np.frombuffer(t, "<u4")[run], pos


def doc_bucket(doc: np.ndarray, tag: np.ndarray, n: int) -> np.ndarray:
    return (doc % n + tag.astype(np.int64) % n) % n


def _rows_to_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _MARKS)], schema=_MARKS)


def _pack_marks(doc, tag, pos, n_docs: int) -> list[tuple]:
    b = doc_bucket(doc, tag, n_docs)
    o = np.lexsort((pos, tag, doc, b))
    return pack(b[o], doc[o], tag[o], pos[o])


# --- the three tasks -------------------------------------------------------

def hash_chunk(ids: np.ndarray, tags: np.ndarray, texts: list[bytes], size: int, bits: int, n_docs: int) -> list[tuple]:
    """Task 1 for one chunk: packed first windows by hash bucket, and packed
    marks of windows repeated inside the chunk (``h`` NULL, bucket negative)."""
    order = np.lexsort((tags, ids))
    parts = [texts[i].split() for i in order]
    lens = np.array([len(x) for x in parts], np.int64)
    flat = np.empty(int(lens.sum()), object)
    flat[:] = [w for x in parts for w in x]
    if len(flat) < size:
        return []
    hashes = window_hashes(pd.util.hash_array(flat, categorize=False), size)
    del flat, parts
    owner = np.repeat(np.arange(len(lens)), lens)[:len(hashes)]
    pos = np.arange(len(hashes)) - (np.cumsum(lens) - lens)[owner]
    inside = pos + size <= lens[owner]
    hashes, owner, pos = hashes[inside], owner[inside], pos[inside]
    doc, tag = ids[order][owner], tags[order][owner]
    by = np.argsort(hashes, kind="stable")          # ties stay in order (doc, tag, pos)
    first, later = _first_and_later(hashes[by], doc[by], pos[by])
    marks = by[later]
    rows = [(-1 - b, *rest) for b, *rest in _pack_marks(doc[marks], tag[marks], pos[marks], n_docs)]
    go = np.sort(by[first])
    bucket = (hashes[go] & _U((1 << bits) - 1)).astype(np.int64)
    o = np.argsort(bucket, kind="stable")
    go = go[o]
    return pack(bucket[o], doc[go], tag[go], pos[go], hashes[go] >> _U(bits)) + rows


def _first_and_later(hashes, doc, pos) -> tuple[np.ndarray, np.ndarray]:
    """Of windows sorted by hash: those at their hash's smallest (doc, pos), and the others."""
    if not len(hashes):
        return np.empty(0, bool), np.empty(0, bool)
    start = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    size = np.diff(np.r_[start, len(hashes)])
    if (size == 1).all():
        return np.ones(len(hashes), bool), np.zeros(len(hashes), bool)
    lo_doc = np.minimum.reduceat(doc, start)
    at_doc = doc == np.repeat(lo_doc, size)
    lo_pos = np.minimum.reduceat(np.where(at_doc, pos, np.iinfo(np.int64).max), start)
    first = at_doc & (pos == np.repeat(lo_pos, size))
    return first, ~first


def _hash_task(size: int, bits: int, n_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            tags = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint32)
            texts = batch.column(2)
            lens = np.array([len(x) for x in texts.to_pylist()], np.int64) if len(texts) else np.empty(0, np.int64)
            a = 0
            while a < len(lens):
                b = max(a + 1, a + int(np.searchsorted(np.cumsum(lens[a:]), CHUNK_BYTES, "right")))
                yield _rows_to_batch(hash_chunk(ids[a:b], tags[a:b], texts[a:b].to_pylist(), size, bits, n_docs))
                a = b
    return run


def _mark_task(n_docs: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if rows and rows[0]["bucket"] < 0:          # settled already: passed on
            return pa.Table.from_batches([_rows_to_batch(
                [(-1 - r["bucket"], None, r["d"], r["t"], r["c"], r["p"]) for r in rows])])
        parts = [(*unpack(r["d"], r["t"], r["c"], r["p"]), r["h"]) for r in rows]
        del rows
        if not parts:
            return pa.Table.from_batches([_rows_to_batch([])])
        doc, tag, pos = (np.concatenate([x[i] for x in parts]) for i in range(3))
        raw = np.zeros((len(doc), 8), np.uint8)
        raw[:, :7] = np.frombuffer(b"".join(x[3] for x in parts), np.uint8).reshape(-1, 7)
        del parts
        hashes = raw.view("<u8").reshape(-1)
        by = np.argsort(hashes, kind="stable")
        s = hashes[by]
        same = np.r_[False, s[1:] == s[:-1]]
        several = by[same | np.r_[same[1:], False]]
        _, later = _first_and_later(hashes[several], doc[several], pos[several])
        m = several[later]
        return pa.Table.from_batches([_rows_to_batch(_pack_marks(doc[m], tag[m], pos[m], n_docs))])
    return run


def cut(words: list[bytes], marks: np.ndarray, size: int) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words outside the marked windows, and the maximal removed intervals."""
    if not len(marks):
        return words, []
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, marks, 1)
    np.add.at(change, marks + size, -1)
    out = np.cumsum(change)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.r_[False, out, False].astype(np.int8)))
    spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
    return [w for w, gone in zip(words, out) if not gone], spans


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept", pa.binary()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _cut_task(size: int):
    def run(marks: pa.Table, docs: pa.Table) -> pa.Table:
        parts = [unpack(*x) for x in zip(*(marks.column(c).to_pylist() for c in "dtcp"))]
        doc, tag, pos = ((np.concatenate([x[i] for x in parts]) for i in range(3)) if parts
                         else (np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.int64)))
        o = np.lexsort((pos, tag, doc))
        doc, tag, pos = doc[o], tag[o], pos[o]
        edges = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]) if len(doc) else []
        at = {(int(doc[a]), int(tag[a])): pos[a:b] for a, b in zip(edges, [*edges[1:], len(doc)])}
        none = np.empty(0, np.int64)
        rows = []
        for i, t, text in zip(docs.column("doc_id").to_pylist(), docs.column("tag").to_pylist(),
                              docs.column("text").to_pylist()):
            ws = text.split()
            kept, spans = cut(ws, at.get((int(NULL_ID) if i is None else i, t), none), size)
            rows.append((i, len(ws), len(ws) - len(kept), b" ".join(kept),
                         [{"start": a, "end": b} for a, b in spans]))
        cols = list(zip(*rows)) or [[]] * 5
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RESULT)], schema=_RESULT)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed): the words that stay, joined
    by one space, and the removed intervals of words, end exclusive."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(6, (partitions - 1).bit_length())
    n_docs = 3 * partitions + 1     # marks leave a hash bucket in at most so many rows
    text = F.coalesce(F.col(text_col), F.lit(""))
    tag = F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), tag.alias("tag"), text.cast("binary").alias("text"))
    packed = rows.mapInArrow(_hash_task(size, bits, n_docs), PACKED)
    marks = packed.groupBy("bucket").applyInArrow(_mark_task(n_docs), PACKED)
    # the same number as doc_bucket() gives
    mod = lambda c: F.col(c) % n_docs
    keyed = rows.withColumn("bucket", F.pmod(
        F.pmod(F.coalesce(F.col("doc_id"), F.lit(int(NULL_ID))), F.lit(n_docs)) + mod("tag"), F.lit(n_docs)).cast("int"))
    out = marks.groupBy("bucket").cogroup(keyed.groupBy("bucket")).applyInArrow(
        _cut_task(size), "doc_id long, n_words long, n_removed long, kept binary, "
                         "removed array<struct<start: long, end: long>>")
    return out.withColumn("kept", F.col("kept").cast("string"))
