"""Near-duplicate groups by HyperMinHash.

A text is the set of its ``SHINGLE``-word shingles (64-bit hashes). Every shingle falls
into one of ``BUCKETS`` buckets; a bucket keeps its smallest hash as a 16-bit register:
the count of leading zeros and the ``MANTISSA`` bits after them. An empty bucket takes
the register of the first filled one in an order of its own, so a register of two texts
agrees with the chance of their Jaccard similarity at any size. Registers are banded;
texts that share a band are candidates if their estimated similarity, the share of equal
registers corrected for the equal registers that different minima give by chance,
reaches ``THRESHOLD - MARGIN``, and linked if the exact similarity of their whole sets
reaches the threshold.

Links are looked for in two steps, since the result is groups, not pairs:

1. Every text of a band's bucket meets the bucket's first text only. The links found
   make groups; in buckets whose texts are all of one group nothing is left to find.
2. In the other buckets, texts of different groups meet, block against block inside
   tasks (blocks of about ``BLOCK_TEXTS`` texts or ``BLOCK_SHINGLES`` shingles); a pair
   is looked at in the first band it shares only. A task returns links that join
   groups it has not joined yet, fewer than it has texts.

Scale: equal word sequences become one text first. Bands are counted by partial aggregates, never
collected; texts alone in all their bands leave before any set is made. Registers
take 240 bytes a text. Sets are made for candidates only. A bucket of n near copies costs n
comparisons as long as they are like its first text; only the texts of a bucket that
fall into different groups are compared with each other.

Recall: at similarity 0.8, 1 - (1 - 0.8^ROWS)^BANDS = 0.99993 by the bands; the estimate's
standard deviation is at most about 0.05, so the margin is four times that.

Defined results: words are split at ASCII white space, A-Z lower-cased; a text of one to
three words is one shingle; texts without words (NULL, empty, blank) have no shingles
and are their own component; NULL ids take part, a component's id is its smallest
non-NULL id (NULL if it has none); repeated rows are copies and share their result; an empty table gives
an empty result. Only the id and the text are read; other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stage
from .components import components

SHINGLE = 4
THRESHOLD = 0.8
ROWS, BANDS = 5, 24
BUCKETS = ROWS * BANDS
MANTISSA = 10
MARGIN = 0.2
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 1_000_000
CHUNK_BYTES = 2_000_000     # text hashed at a time; a longer text is a chunk

_U = np.uint64
_RNG = np.random.default_rng(12)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_PLACE = _RNG.integers(1, 2**63, SHINGLE, dtype=_U) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C13)
_KEYS = _RNG.integers(1, 2**63, 2, dtype=_U) * _U(2) + _U(1)
#: The order in which an empty bucket asks the others.
_ASK = np.argsort(_RNG.random((BUCKETS, BUCKETS)), axis=1).astype(np.int16)
_EMPTY = np.uint16(0xFFFF)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the texts, in order, and each text's number of
    words. A word's hash is a polynomial of random values of its bytes modulo
    2^64, the difference of two running sums times a power of the base's inverse."""
    joined = np.frombuffer(b" ".join(t or b"" for t in texts) + b" ", np.uint8)
    ends_of_texts = np.cumsum([len(t or b"") + 1 for t in texts])
    code = _LOWER[joined]
    space = _SPACE[code]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(joined)
    running = np.concatenate([np.zeros(1, _U), np.cumsum(np.where(space, _U(0), _BYTE[code]) * _powers(n))])
    inverse = _U(pow(int(_BASE), -1, 2**64))
    down = np.full(n, inverse, _U)
    down[:1] = 1
    down = np.multiply.accumulate(down)
    words = _mix((running[end] - running[start]) * down[start] + (end - start).astype(_U)) if len(start) else np.zeros(0, _U)
    counts = np.diff(np.concatenate([[0], np.searchsorted(start, ends_of_texts)]))
    return words, counts


def shingles(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in a row, how many each has, and a
    128-bit key of each text's word sequence."""
    w, lens = word_hashes(texts)
    first = np.cumsum(lens) - lens
    place = np.arange(len(w)) - np.repeat(first, lens)
    salted = w + place.astype(_U) * _BASE
    keys = np.zeros((len(texts), 2), _U)
    some = lens > 0
    if len(w):
        for k in range(2):
            keys[some, k] = np.add.reduceat(_mix(salted * _KEYS[k] + _U(k)), first[some])
    n = np.where(lens == 0, 0, np.maximum(lens - SHINGLE + 1, 1))
    start = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    size = np.repeat(np.minimum(lens, SHINGLE), n)
    h = size.astype(_U)
    for k in range(SHINGLE):
        at = np.minimum(start + k, max(len(w) - 1, 0))
        h = h + np.where(size > k, w[at] * _PLACE[k], _U(0)) if len(w) else h
    return _mix(h), n, keys


def registers(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(texts, BUCKETS) registers of the texts' shingle hashes."""
    low = np.full(len(n) * BUCKETS, _U(2**64 - 1))
    # the bucket comes from the hash, its value from another mix of it
    place = np.repeat(np.arange(len(n)), n) * BUCKETS + ((h >> _U(33)) % _U(BUCKETS)).astype(np.int64)
    np.minimum.at(low, place, _mix(h ^ _KEYS[0]) >> _U(1))
    filled = low != _U(2**64 - 1)
    zeros = np.minimum(63 - np.frexp((low & ~_U(0x7FF)).astype(np.float64))[1], 62).astype(_U)  # of 63 bits
    after = (low << (zeros + _U(2))) >> _U(64 - MANTISSA)
    out = np.where(filled, (zeros << _U(MANTISSA) | after).astype(np.uint16), _EMPTY).reshape(-1, BUCKETS)
    filled = filled.reshape(-1, BUCKETS)
    full = out.copy()
    row, bucket = np.nonzero(~filled & (n > 0)[:, None])
    for step in range(BUCKETS):
        if not len(row):
            break
        asked = _ASK[bucket, step]
        got = filled[row, asked]
        full[row[got], bucket[got]] = out[row[got], asked[got]]
        row, bucket = row[~got], bucket[~got]
    return full


def chance_equal(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The chance that two different minima, of n and m shingles dealt over
    the buckets, give the same register: the sum over leading-zero counts of the
    chance that both fall into one of the cells of that count."""
    a, b = np.maximum(n / BUCKETS, 1.0), np.maximum(m / BUCKETS, 1.0)
    out = np.zeros(len(a))
    for zeros in range(63):
        top = 2.0**-zeros
        cell = top / 2 / 2**MANTISSA
        out += a * b * cell / np.maximum(a + b - 1, 1) * ((1 - top / 2)**(a + b - 1) - (1 - top)**(a + b - 1))
    return out


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The collision-corrected similarity of registers x and y (row by row)."""
    chance = chance_equal(n, m)
    return ((x == y).mean(-1) - chance) / (1 - chance)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    a, part, size = 0, [], 0
    for k, t in enumerate(texts):
        t = t.as_py()
        if part and size + len(t or b"") > CHUNK_BYTES:
            yield a, part
            a, part, size = k, [], 0
        part.append(t)
        size += len(t or b"")
    if part:
        yield a, part


def _sign_task(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in _chunks(batch.column(1)):
                h, n, keys = shingles(texts)
                ends = np.cumsum(n)
                sizes = np.array([len(np.unique(x)) for x in np.split(h, ends[:-1])], np.int64)
                regs = registers(h, n).tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, len(texts)).cast(id_type), batch.column(2).slice(a, len(texts)),
                    pa.array(keys[:, 0].view(np.int64)), pa.array(keys[:, 1].view(np.int64)), pa.array(sizes),
                    pa.array([regs[2 * BUCKETS * k:2 * BUCKETS * (k + 1)] for k in range(len(texts))], pa.binary())],
                    ["doc_id", "xh", "k1", "k2", "n", "regs"])
    return run


def _set_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of every candidate's text, sorted. The text was found by its
    row's id and hash; rows whose text has another key are left out."""
    for batch in batches:
        for a, texts in _chunks(batch.column(1)):
            h, n, keys = shingles(texts)
            part = batch.slice(a, len(texts))
            right = ((keys[:, 0].view(np.int64) == part.column(2).to_numpy())
                     & (keys[:, 1].view(np.int64) == part.column(3).to_numpy()))
            sets = [np.unique(x.view(np.int64)) for x, ok in zip(np.split(h, np.cumsum(n)[:-1]), right) if ok]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *sets])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).filter(pa.array(right)), pa.ListArray.from_arrays(offsets, pa.array(flat))], ["vid", "set"])


def _estimate_task(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                        for c in ("ru", "rv"))
                close = estimate(x, y, *(batch.column(c).to_numpy().astype(float) for c in ("nu", "nv"))) >= least
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(close)) for c in ("u", "v")], ["u", "v"])
    return run


def _block_task(threshold: float, margin: float):
    limit = Fraction(str(threshold))

    def run(table: pa.Table) -> pa.Table:
        i, j, band = (table.column(c)[0].as_py() for c in ("i", "j", "band"))
        vid, block, size = (table.column(c).to_numpy() for c in ("vid", "block", "n"))
        regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), np.uint16).reshape(-1, BUCKETS)
        sets = table.column("set")
        root = {k: k for k in set(table.column("root").to_pylist())}
        of = table.column("root").to_pylist()

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        b = np.flatnonzero(block == j)
        out: list[tuple[int, int]] = []
        for k in np.flatnonzero(block == i).tolist():
            others = b[(vid[b] > vid[k])] if i == j else b
            if not len(others):
                continue
            same = regs[others] == regs[k]
            bands = same.reshape(len(others), BANDS, ROWS).all(2)
            close = estimate(regs[others], regs[k][None, :], size[others].astype(float),
                             np.full(len(others), float(size[k]))) >= threshold - margin
            for m in others[close & (bands.argmax(1) == band)].tolist():
                if find(of[k]) == find(of[m]):
                    continue
                both = len(np.intersect1d(sets[k].values.to_numpy(), sets[m].values.to_numpy(), assume_unique=True))
                if both * limit.denominator >= (int(size[k]) + int(size[m]) - both) * limit.numerator:
                    out.append((int(vid[k]), int(vid[m])))
                    root[find(of[k])] = find(of[m])
        return pa.table({"u": pa.array([p[0] for p in out], pa.int64()), "v": pa.array([p[1] for p in out], pa.int64())})
    return run


def _linked(threshold: float):
    """Whether the sets su and sv reach the threshold, in whole numbers."""
    limit = Fraction(str(threshold))
    both = F.size(F.array_intersect("su", "sv")).cast("long")
    union = F.size("su") + F.size("sv") - both
    return both * F.lit(limit.denominator) >= union * F.lit(limit.numerator)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    margin: float = MARGIN, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest
    id of all texts linked directly or over others) and kept."""
    id_type = docs.schema[id_col].dataType
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
            .withColumn("xh", F.xxhash64("text")))
    signed = stage(rows.mapInArrow(
        _sign_task(to_arrow_type(id_type)), f"doc_id {id_type.simpleString()}, xh long, k1 long, k2 long, n long, regs binary"),
        "hmh-signed")
    one = F.any_value(F.struct("doc_id", "xh", "n", "regs")).alias("r")
    texts = stage(signed.filter("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("min_id"), one)
                  .select(F.monotonically_increasing_id().alias("vid"), "k1", "k2", "min_id", "r.doc_id", "r.xh", "r.n", "r.regs"),
                  "hmh-texts")

    # 1. texts that share a band, against the first text of its bucket
    band_bytes = 2 * ROWS
    entries = texts.select("vid", "n", "regs", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")).select(
        "vid", "n", "band",
        F.xxhash64("band", F.expr(f"substring(regs, band * {band_bytes} + 1, {band_bytes})")).alias("h"))
    shared = entries.groupBy("h").agg(F.min("vid").alias("first"), F.max("vid").alias("last")).filter("first < last")
    entries = stage(entries.join(shared.drop("last"), "h"), "hmh-entries")
    members = entries.select("vid").distinct().join(texts.drop("regs", "n", "min_id"), "vid")
    wanted = (rows.join(members.withColumnRenamed("doc_id", "of"), (F.col("doc_id").eqNullSafe(F.col("of")))
                        & (rows["xh"] == members["xh"]))
              .groupBy("vid").agg(*[F.any_value(c).alias(c) for c in ("text", "k1", "k2")]))
    sets = stage(wanted.mapInArrow(_set_task, "vid long, set array<long>"), "hmh-sets")
    signs = texts.select("vid", "n", "regs")

    def side(df: DataFrame, of: str) -> DataFrame:
        return df.select(*[F.col(c).alias(of if c == "vid" else f"{c[0]}{of}") for c in df.columns])

    pairs = entries.filter("vid <> first").select(F.col("vid").alias("u"), F.col("first").alias("v")).distinct()
    close = pairs.join(side(signs, "u"), "u").join(side(signs, "v"), "v").mapInArrow(
        _estimate_task(threshold - margin), "u long, v long")
    links = (stage(close, "hmh-close").join(side(sets, "v"), "v").join(side(sets, "u"), "u")
             .filter(_linked(threshold)).select("u", "v"))
    groups = stage(components(stage(links, "hmh-links")), "hmh-groups")

    # 2. buckets of several groups: the rest against the largest group and each other
    rooted = entries.join(groups, F.col("vid") == F.col("vertex"), "left").select(
        "h", "band", "vid", "n", F.coalesce("root", "vid").alias("root"))
    blocks = lambda count, size: F.greatest(F.ceil(count / block_texts), F.ceil(size / BLOCK_SHINGLES)).cast("int")
    per = rooted.groupBy("h", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    mixed = (per.groupBy("h").agg(F.max(F.struct("c", "s", "root")).alias("top"), F.sum("c").alias("c"), F.sum("s").alias("s"))
             .filter(F.col("c") > F.col("top.c"))
             .select("h", F.col("top.root").alias("top"),
                     blocks(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("n_rest"),
                     blocks(F.col("top.c"), F.col("top.s")).alias("n_top")))
    rest = F.col("root") != F.col("top")
    hashed = F.xxhash64("vid")
    cells = (rooted.join(mixed, "h")
             .withColumn("block", F.when(rest, F.pmod(hashed, "n_rest")).otherwise(F.col("n_rest") + F.pmod(hashed, "n_top")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n_rest") - 1 + F.when(rest, F.col("n_top")).otherwise(0))))
             .select("h", "band", "vid", "n", "root", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j")))
    more = stage(cells.join(signs.drop("n"), "vid").join(sets, "vid").groupBy("h", "i", "j").applyInArrow(
        _block_task(threshold, margin), "u long, v long"), "hmh-more")
    at = lambda c: groups.select(F.col("vertex").alias(c), F.col("root").alias(f"r{c}"))
    joined = (more.join(at("u"), "u", "left").join(at("v"), "v", "left")
              .select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
    merged = components(joined).select(F.col("vertex").alias("root"), F.col("root").alias("root2"))

    rooted = (texts.select("vid", "k1", "k2", "min_id").join(groups, F.col("vid") == F.col("vertex"), "left")
              .withColumn("root", F.coalesce("root", "vid")).join(merged, "root", "left")
              .select("k1", "k2", "min_id", F.coalesce("root2", "root").alias("root")))
    rooted = stage(rooted, "hmh-rooted")
    named = rooted.groupBy("root").agg(F.min("min_id").alias("component_id"))
    classes = stage(rooted.join(named, "root").select("k1", "k2", "component_id"), "hmh-classes")
    out = signed.select("doc_id", "k1", "k2", "n").join(classes, ["k1", "k2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
