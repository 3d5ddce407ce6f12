"""Benchmark decontamination by spaced seeds.

Tokens are runs of letters and digits, A-Z lower-cased (bytes of other scripts
count as letters). A document leaks an item if some segment of one diagonal
(substitutions only) holds at least ``MIN_MATCHES`` equal tokens, or 80 % of a
shorter item, and is 80 % equal. A seed is a fixed mask over consecutive tokens
that hashes the positions marked 1 and ignores the others, so a substituted
token at an ignored position leaves the hash unchanged. The masks of an item's
length are chosen so that every such segment holds one of its seeds, wherever
the substitutions are. Seeds of the documents are joined to the seeds of the
benchmark, and the document and the item are compared token by token along the
diagonal of every hit. The segment reported has the most equal tokens of all
that are 80 % equal, without substitutions at its ends.

Scale: the benchmark is the stated query set. It is read in blocks of at most
``BLOCK_TOKENS`` tokens; a block's index (documented bound, about 100 bytes a
token) is broadcast and every document is read once per block, inside tasks,
with no shuffle of documents and no join rows but the verified ones. Documents
are worked on in chunks of bounded size; a long text is never cut. Where a document and an item
repeat the same tokens, the diagonals are marked by whole runs, compared in slices of
``CELLS`` tokens, and those with the same equal places are judged once: memory is bounded, time grows
with the product of the two lengths at a few nanoseconds a pair of tokens.

Defined results: NULL and empty texts match nothing, and NULL or empty items
too; items of one to four tokens are leaked where they stand whole (80 % of them is all
of them), so a benchmark of single common words marks many documents; repeated items
reported each, repeated rows too; an empty benchmark or table gives no rows. Extra
columns of any name are not looked at, and ``drop_leaked`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stage

#: Fixed masks: 1 is hashed, 0 is ignored. Items of a length in SHORT_MASKS
#: have masks of their own.
MASKS = ("11111", "110111")
SHORT_MASKS = {1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("1111", "10111", "11011", "11101"), 6: ("1111", "11011"), 7: (*MASKS, "111011"),
               10: (*MASKS, "11001011"), 11: (*MASKS, "11001011")}
MIN_MATCHES = 12
MIN_IDENTITY = 0.8
BLOCK_TOKENS = 500_000
CHUNK_BYTES = 8_000_000
#: Token pairs compared, and pairs of seed places written out, at a time.
CELLS = 1_000_000
#: Pairs of places of one seed in one document above which they are not written out.
HEAVY = 100_000

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                 for c in range(256))
_MULTIPLIERS = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def tokens(text: bytes | None) -> list[bytes]:
    return text.translate(_LETTERS).split() if text else []


def _seeds(ids: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Start positions whose hashed tokens are all known (id > 0), and their
    hashes: a sum of token ids times one odd multiplier per mask position."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    on = [i for i, c in enumerate(mask) if c == "1"]
    known = ids > 0
    ok = known[on[0]:on[0] + n].copy()
    for i in on[1:]:
        ok &= known[i:i + n]
    at = np.flatnonzero(ok)
    key = np.zeros(len(at), np.uint64)
    for i in on:
        key += ids[at + i].astype(np.uint64) * _MULTIPLIERS[i]
    return at, key


class Index:
    """Seeds of one block of benchmark items."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.names = [name for name, _ in items]
        self.vocab: dict[bytes, int] = {}
        self.items = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws], np.int32)
                      for _, ws in items]
        found: dict[str, list] = {}
        for k, ids in enumerate(self.items):
            for m in SHORT_MASKS.get(len(ids), MASKS):
                at, key = _seeds(ids, m)
                found.setdefault(m, []).append((key, np.full(len(at), k), at))
        self.seeds = {}
        for m, parts in found.items():
            key, item, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(key, kind="stable")
            self.seeds[m] = (key[order], item[order], at[order])
        self.lens = np.array([len(ids) for ids in self.items], np.int64)
        self.needs = np.minimum(MIN_MATCHES, -(-self.lens * 4 // 5))
        self.starts = np.cumsum(self.lens) - self.lens
        self.flat = np.concatenate([np.empty(0, np.int32), *self.items])

    def candidates(self, flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document, item, offsets of the item's start in the document): the diagonals that
        hold a seed and enough equal tokens. The documents lie in ``flat`` at ``starts``."""
        light, heavy = [], {}
        for m, a in ((m, a) for m in self.seeds for a in range(0, len(flat) - len(m) + 1, CELLS)):
            keys, item, at = self.seeds[m]
            pos, key = _seeds(flat[a:a + CELLS + len(m) - 1], m)
            pos += a
            lo = np.searchsorted(keys, key, "left")
            n = np.searchsorted(keys, key, "right") - lo
            hit = n > 0
            pos, key, lo, n = pos[hit], key[hit], lo[hit], n[hit]
            doc = np.searchsorted(starts, pos, "right") - 1
            if n.sum() > HEAVY:
                order = np.lexsort((doc, key))
                k, d = key[order], doc[order]
                runs = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])]))
                size = np.diff(np.append(runs, len(k)))
                rest = np.ones(len(pos), bool)
                for r in np.flatnonzero(size * n[order[runs]] > HEAVY):
                    rows = order[runs[r]:runs[r] + size[r]]
                    rest[rows] = False
                    x, first = int(doc[rows[0]]), lo[rows[0]]
                    here = pos[rows] - starts[x]
                    owners = item[first:first + n[rows[0]]]
                    cuts = np.append(np.flatnonzero(np.diff(owners, prepend=-1)), len(owners))
                    for c, e in zip(cuts[:-1], cuts[1:]):
                        heavy.setdefault((x, int(owners[c])), []).append((here, at[first + c:first + e]))
                pos, lo, n, doc = pos[rest], lo[rest], n[rest], doc[rest]
            ends, done = np.cumsum(n), 0
            while done < len(n):
                last = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + CELLS, "right")))
                c = n[done:last]
                row = np.repeat(lo[done:last] - (np.cumsum(c) - c), c) + np.arange(c.sum())
                where = np.repeat(doc[done:last], c)
                light.append(_distinct(np.stack([where, item[row], np.repeat(pos[done:last], c) - at[row] - starts[where]])))
                done = last
        if light:
            found = self.enough(flat, starts, lens, _distinct(np.concatenate(light, axis=1)))
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(found[:2], axis=1) != 0).any(0)])) if found.size else []
            for a, b in zip(cuts, [*cuts[1:], found.shape[1]]):
                yield int(found[0, a]), int(found[1, a]), found[2, a:b]
        for (d, k), parts in heavy.items():
            yield d, k, self.diagonals(int(lens[d]), k, parts)

    def diagonals(self, n: int, k: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The distinct differences of places (ascending) in a document of ``n`` tokens and in item
        ``k``, marked by whole runs: no pair of places is written out."""
        size = int(self.lens[k])
        marks = np.zeros(n + size, bool)                # offset + size
        for here, there in parts:
            low, wide = int(here[0]), int(here[-1] - here[0]) + 1
            if len(there) * wide <= len(here) * size:
                held = np.zeros(wide, bool)
                held[here - low] = True
                for a in there.tolist():
                    marks[low + size - a:low + size - a + wide] |= held
            else:
                held = np.zeros(size, bool)
                held[size - 1 - there] = True
                for p in here.tolist():
                    marks[p + 1:p + 1 + size] |= held
        return np.flatnonzero(marks) - size

    def enough(self, flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """The hits (document, item, offset) whose whole diagonals hold the equal tokens a leak needs."""
        out, first = [], 0
        ends = np.cumsum(self.lens[hits[1]])
        while first < hits.shape[1]:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + CELLS, "right")))
            doc, item, offset = part = hits[:, first:last]
            n = self.lens[item]
            rows = np.cumsum(n) - n
            k = np.arange(n.sum()) - np.repeat(rows, n)
            at = np.repeat(offset, n) + k
            inside = (at >= 0) & (at < np.repeat(lens[doc], n))
            at = np.where(inside, at + np.repeat(starts[doc], n), 0)
            equal = inside & (flat[at] == self.flat[np.repeat(self.starts[item], n) + k])
            out.append(part[:, np.add.reduceat(equal.astype(np.int64), rows) >= self.needs[item]])
            first = last
        return np.concatenate(out, axis=1) if out else hits

    def best(self, doc: np.ndarray, k: int, offsets: np.ndarray) -> tuple[int, int, int, int] | None:
        """(equal tokens, segment length, start in doc, start in item) of the best segment on any of the
        diagonals (ascending), if one is long and equal enough; the greatest of equally good ones."""
        need, best = int(self.needs[k]), None
        step = max(1, CELLS // int(self.lens[k]))
        for first in range(0, len(offsets), step):
            off = offsets[first:first + step]
            equal = _equal(doc, self.items[k], off)
            able = equal.sum(1, dtype=np.int32) >= max(need, best[0] if best else 0)
            equal, off = equal[able], off[able]
            if len(off) > 1:            # of diagonals with the same equal places the last one counts
                bits = np.ascontiguousarray(np.packbits(equal, axis=1)[::-1])
                row = len(off) - 1 - np.unique(bits.view(f"V{bits.shape[1]}").ravel(), return_index=True)[1]
                equal, off = equal[row], off[row]
            if len(off):
                most, size, start = _segments(equal)
                top = max(zip(most.tolist(), size.tolist(), (off + start).tolist(), start.tolist()))
                if top[0] >= need and (best is None or top > best):
                    best = top
        return best

    def search(self, texts: list[bytes | None]) -> Iterator[tuple[int, int, tuple[int, int, int, int]]]:
        """(text, item, best segment) for every verified pair."""
        gap = np.zeros(max(map(len, self.seeds), default=0), np.int32)
        first = 0
        while first < len(texts):
            size, last = 0, first
            while last < len(texts) and (last == first or size + len(texts[last] or b"") <= CHUNK_BYTES):
                size += len(texts[last] or b"")
                last += 1
            docs = [np.fromiter((self.vocab.get(w, 0) for w in tokens(t)), np.int32) for t in texts[first:last]]
            lens = np.array([len(d) for d in docs], np.int64)
            starts = np.cumsum(lens + len(gap)) - lens - len(gap)
            flat = np.concatenate([x for d in docs for x in (d, gap)])
            best: dict[tuple[int, int], tuple] = {}
            for d, item, offsets in self.candidates(flat, starts, lens):
                seg = self.best(docs[d], item, offsets)
                if seg and seg > best.get((d, item), (0,)):
                    best[d, item] = seg
            for (d, item), seg in sorted(best.items()):
                yield first + d, item, seg
            first = last


def _distinct(hits: np.ndarray) -> np.ndarray:
    """The distinct columns, in order."""
    hits = hits[:, np.lexsort(hits[::-1])]
    return hits[:, np.concatenate([[True], (np.diff(hits, axis=1) != 0).any(0)])] if hits.size else hits


def _equal(doc: np.ndarray, item: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Per offset (ascending) and token of the item: is it the document's token there?"""
    lo, hi = int(off[0]), int(off[-1]) + len(item)
    if hi - lo <= 4 * (len(off) + len(item)):       # close together: windows over one stretch
        part = np.zeros(hi - lo, doc.dtype)
        a, b = max(lo, 0), min(hi, len(doc))
        if b > a:
            part[a - lo:b - lo] = doc[a:b]
        rows = np.lib.stride_tricks.sliding_window_view(part, len(item))
        return (rows if len(rows) == len(off) else rows[off - lo]) == item
    at = off[:, None] + np.arange(len(item))
    return (doc[np.clip(at, 0, len(doc) - 1)] == item) & (at >= 0) & (at < len(doc))


def _segments(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(equal tokens, length, start) of the best segment of every row that is 80 % equal: the
    most equal tokens, then the shortest, then the first."""
    rows, n = equal.shape
    edge = np.zeros((rows, 1), np.int64)
    # match +1, substitution -4: a segment is 80 % equal where its sum is not
    # negative; to every end belongs the earliest start that is no higher
    score = np.concatenate([edge, np.cumsum(np.where(equal, 1, -4), axis=1)], axis=1)
    count = np.concatenate([edge, np.cumsum(equal, axis=1)], axis=1)
    row = np.arange(rows)[:, None]
    apart = row * (5 * n + 1)                       # the rows as one ascending sequence
    low = (apart - np.minimum.accumulate(score, axis=1)).ravel()
    start = np.searchsorted(low, (apart - score).ravel(), "left").reshape(rows, n + 1) - row * (n + 1)
    same = count - np.take_along_axis(count, start, axis=1)
    most = same.max(1)
    place = np.arange(n)
    after = np.minimum.accumulate(np.where(equal, place, n)[:, ::-1], axis=1)[:, ::-1]
    after = np.take_along_axis(np.concatenate([after, edge + n], axis=1), start, axis=1)
    before = np.concatenate([edge - 1, np.maximum.accumulate(np.where(equal, place, -1), axis=1)], axis=1)
    size = np.where(same == most[:, None], before - after + 1, n + 1)
    end = size.argmin(1)
    return most, size[np.arange(rows), end], after[np.arange(rows), end]


def _blocks(bench: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The searchable items in blocks, streamed from the table."""
    block, size = [], 0
    rows = bench.select(F.col(id_col), F.col(text_col).cast("binary"))
    for name, text in rows.toLocalIterator():
        ws = tokens(bytes(text) if text is not None else None)
        if not ws:
            continue
        if block and size + len(ws) > BLOCK_TOKENS:
            yield block
            block, size = [], 0
        block.append((name, ws))
        size += len(ws)
    if block:
        yield block


def leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_equal, n_tokens, doc_start, item_start): the best
    overlap of every document and item that overlap; positions in tokens."""
    spark = docs.sparkSession
    id_type, item_type = docs.schema[id_col].dataType, bench.schema[item_col].dataType
    schema = (f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, "
              "n_equal long, n_tokens long, doc_start long, item_start long")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    out = None
    for block in _blocks(bench, item_col, item_text_col):
        index = spark.sparkContext.broadcast(Index(block))

        def scan(batches, index=index):
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                rows = [(ids[d], index.value.names[item], *map(int, seg)) for d, item, seg in index.value.search(texts)]
                cols = list(zip(*rows)) or [[]] * 6
                types = [to_arrow_type(id_type), to_arrow_type(item_type), *[pa.int64()] * 4]
                names = ["doc_id", "item_id", "n_equal", "n_tokens", "doc_start", "item_start"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        found = source.mapInArrow(scan, schema)
        out = found if out is None else stage(out, "leaks").unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def drop_leaked(docs: DataFrame, bench: DataFrame, text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The input rows that overlap no benchmark item."""
    spark = docs.sparkSession
    for k, block in enumerate(_blocks(bench, item_col, item_text_col)):
        index = spark.sparkContext.broadcast(Index(block))

        @F.pandas_udf("boolean")
        def leaked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                flags = np.zeros(len(texts), bool)
                for d, _, _ in index.value.search([bytes(t) if t is not None else None for t in texts]):
                    flags[d] = True
                yield pd.Series(flags)

        docs = (stage(docs, "leak-pass") if k else docs).filter(~leaked(F.col(text_col).cast("binary")))
    return docs
