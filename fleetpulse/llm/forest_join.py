"""N-gram Jaccard join by a MinHash LSH forest.

Texts are sets of ``SHINGLE``-word shingles. A text's signature holds ``TREES``
labels, each a sequence of min-hashes; texts in the order of a tree's labels
are a prefix trie, and texts that share a prefix are candidates. The prefix
starts at ``MAX_DEPTH`` min-hashes and is shortened until the chance that two
texts exactly at the threshold share it in some tree,
1 - (1 - threshold^depth)^trees, reaches ``TARGET_RECALL``; more similar texts
have a higher chance. A prefix holds all matches of the longer ones, so the
rows are grouped once, at the depth where the shortening stops. Candidates that
hang together are then compared exactly on their shingle sets (64-bit hashes),
so no false link is reported, and links inside a group that no tree gave are
found too.

Scale: equal texts (md5) become one row with a count first. Candidates are
stars around a prefix's smallest member, from a partial aggregation and a join
back, never pairs. Hanging-together groups come from ``components``. A group is
compared in blocks of about ``BLOCK`` texts: one task a pair of blocks, products
of 0/1 matrices, output one row a text (its links in these blocks and the
smallest text reached). No group is cut or sampled; within a group of n
different near copies all n * n / 2 similarities are computed, but only n
rows per block pair leave the tasks.

Defined results: a text of one to four words is one shingle; texts without
words (NULL, empty, blank) are linked to nothing, each its own class; NULL ids
take part, a class's id is its smallest non-NULL id (NULL if it has none);
repeated rows are copies; an empty table gives an empty result. Only the id and
the text are read; other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stage
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
MAX_DEPTH = 10
TARGET_RECALL = 0.999
BLOCK = 256
CHUNK = 32_768          # shingles hashed at a time
CHUNK_BYTES = 2_000_000 # text split into words at a time
COLUMNS = 8192          # shingles multiplied at a time

_RNG = np.random.default_rng(5)
_PLACE = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _RNG.integers(1, 2**63, TREES * MAX_DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, TREES * MAX_DEPTH, dtype=np.uint64)


def recall(depth: int, trees: int, similarity: float) -> float:
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, target: float = TARGET_RECALL) -> int:
    """The longest prefix whose recall at the threshold reaches the target."""
    depth = MAX_DEPTH
    while depth > 1 and recall(depth, trees, threshold) < target:
        depth -= 1
    return depth


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts in a row, and how many each has."""
    parts = [t.split() if t else [] for t in texts]
    lens = np.array([len(p) for p in parts], np.int64)
    flat = np.empty(int(lens.sum()), object)
    flat[:] = [w for p in parts for w in p]
    w = pd.util.hash_array(flat, categorize=False).astype(np.uint64) if len(flat) else np.empty(0, np.uint64)
    n = np.where(lens == 0, 0, np.maximum(lens - SHINGLE + 1, 1))
    # word positions of every shingle; short texts read past their end and mask it
    start = np.repeat(np.cumsum(lens) - lens, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    size = np.repeat(np.minimum(lens, SHINGLE), n)
    h = size.astype(np.uint64)
    for k in range(SHINGLE):
        at = np.minimum(start + k, max(len(w) - 1, 0))
        h = h + np.where(size > k, w[at] * _PLACE[k], np.uint64(0)) if len(w) else h
    return _mix(h), n


def _label_chunk(texts: list[bytes | None], depth: int, trees: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((len(texts), trees), np.uint64)
    h, n = shingles(texts)
    some = np.flatnonzero(n)
    ends = np.cumsum(n[some])
    a = 0
    while a < len(some):
        lo = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, lo + CHUNK, "right")))
        x, starts = h[lo:int(ends[b - 1])], np.concatenate([[0], ends[a:b - 1] - lo]).astype(np.int64)
        for tree in range(trees):
            label = np.full(b - a, tree, np.uint64)
            for level in range(depth):
                k = tree * MAX_DEPTH + level
                label = _mix(label + np.minimum.reduceat(x * _A[k] + _B[k], starts))
            out[some[a:b], tree] = label
        a = b
    return out, n


def labels(texts: list[bytes | None], depth: int, trees: int = TREES) -> tuple[np.ndarray, np.ndarray]:
    """(labels, shingle counts): a row of ``trees`` 64-bit hashes of the first
    ``depth`` min-hashes a text; texts without words get zeros. Texts are split
    into words ``CHUNK_BYTES`` at a time."""
    parts, a = [(np.zeros((0, trees), np.uint64), np.zeros(0, np.int64))], 0
    while a < len(texts):
        size, b = 0, a
        while b < len(texts) and (b == a or size + len(texts[b] or b"") <= CHUNK_BYTES):
            size += len(texts[b] or b"")
            b += 1
        parts.append(_label_chunk(texts[a:b], depth, trees))
        a = b
    return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _sign_task(depth: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, n = labels(batch.column(2).to_pylist(), depth)
            lists = pa.ListArray.from_arrays(np.arange(0, label.size + 1, TREES, dtype=np.int32),
                                             pa.array(label.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), batch.column(1), pa.array(n), lists],
                ["doc_id", "key", "n", "labels"])
    return run


def _intersections(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of a with every one of b."""
    na, sets = len(sets_a), [*sets_a, *sets_b]
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(column, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    on = shared[column]
    row, column = row[on], place[column[on]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((na, len(sets_b)), np.float32)
    for c in range(0, int(shared.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [c, c + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, int(shared.sum()) - c)), np.float32)
        m[row[lo:hi], column[lo:hi] - c] = 1
        out += m[:na] @ m[na:].T
    return out.astype(np.int64)


def _roots(link: np.ndarray) -> np.ndarray:
    """The smallest index reached from each index of a symmetric matrix."""
    root = np.arange(len(link))
    while True:
        new = np.where(link, root[None, :], len(link)).min(1)
        new = np.minimum(root, new)
        new = new[new]
        if (new == root).all():
            return root
        root = new


_VERIFIED = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary()), ("blocks", pa.int32())])


def _verify_task(threshold: float):
    limit = Fraction(str(threshold))

    def run(table: pa.Table) -> pa.Table:
        o = sorted(range(table.num_rows), key=table.column("key").to_pylist().__getitem__)
        table = table.take(pa.array(o))
        keys, copies = table.column("key").to_pylist(), table.column("copies").to_numpy()
        block, blocks = table.column("block").to_numpy(), table.column("blocks").to_pylist()
        h, n = shingles(table.column("text").to_pylist())
        sets = [np.unique(x) for x in np.split(h, np.cumsum(n)[:-1])]
        size = np.array([len(s) for s in sets])
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        both = _intersections([sets[k] for k in a], [sets[k] for k in b])
        total = size[a][:, None] + size[b][None, :] - both
        linked = both * limit.denominator >= total * limit.numerator
        full = np.zeros((len(sets), len(sets)), bool)
        full[np.ix_(a, b)] = linked
        full |= full.T
        np.fill_diagonal(full, False)
        links = full @ copies.astype(np.int64)
        root = _roots(full)
        return pa.Table.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(links, pa.int64()),
             pa.array([keys[r] for r in root], pa.binary()), pa.array(blocks, pa.int32())], schema=_VERIFIED)
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, target: float = TARGET_RECALL, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, key (md5 of the text), class_id (smallest
    id of all texts linked directly or over others), n_links (other rows with a
    Jaccard similarity of ``threshold`` or more) and chosen (the row, or its
    repetition, that stands for the class)."""
    depth = prefix_depth(threshold, TREES, target)
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), _text_key(F.col(text_col)).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    signed = stage(rows.mapInArrow(_sign_task(depth, to_arrow_type(id_type)),
                                   f"doc_id {id_type.simpleString()}, key binary, n long, labels array<long>"),
                   "forest-signed")
    texts = signed.filter("n > 0").groupBy("key").agg(
        F.min("doc_id").alias("min_id"), F.count(F.lit(1)).alias("copies"), F.any_value("labels").alias("labels"))
    texts = stage(texts, "forest-texts")

    entries = texts.select("key", F.explode("labels").alias("prefix"))
    nodes = (entries.groupBy("prefix").agg(F.min("key").alias("v"), F.count(F.lit(1)).alias("members"))
             .filter("members > 1").drop("members"))
    edges = entries.join(nodes, "prefix").filter("key <> v").select(F.col("key").alias("u"), "v")
    groups = components(edges)
    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    members = (groups.join(sizes, "root")
               .join(texts.select("key", "copies"), F.col("vertex") == F.col("key")).drop("vertex")
               .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")))
    # copies of a text meet in partial aggregates before the shuffle
    wanted = rows.groupBy("key").agg(F.any_value("text").alias("text")).join(members, "key")
    pairs = (wanted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other"))
    verified = stage(pairs.groupBy("root", "i", "j").applyInArrow(
        _verify_task(threshold), "key binary, links long, root binary, blocks int"), "forest-verified")

    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    # a group in one block is settled in its task; the others' trees are merged
    one = verified.filter("blocks = 1").select("key", "root")
    more = components(verified.filter("blocks > 1 AND key <> root").select(F.col("key").alias("u"), F.col("root").alias("v")))
    roots = one.unionByName(more.select(F.col("vertex").alias("key"), "root"))
    classed = (texts.drop("labels").join(links, "key", "left").join(roots, "key", "left")
               .withColumn("root", F.coalesce("root", "key"))
               .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1))
    best = classed.groupBy("root").agg(F.min(F.struct(
        F.col("min_id").isNull().alias("none"), F.col("min_id"), F.col("key"))).alias("best"))
    classed = classed.join(best, "root").select(
        "key", "links", F.col("best.min_id").alias("class_id"), F.col("best.key").alias("best_key"))
    out = signed.select("doc_id", "key", "n").join(classed, "key", "left")
    empty = F.col("n") == 0
    return out.select(
        "doc_id", "key",
        F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        (empty | ((F.col("key") == F.col("best_key")) & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("chosen"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of every class: the text with the smallest id. Rows that repeat
    id and text are one document."""
    chosen = (near_duplicates(docs, id_col, text_col, **options).filter("chosen")
              .select(F.struct("doc_id", "key").alias("__who")).distinct())
    rows = docs.select(F.struct("*").alias("__d"), F.struct(
        F.col(id_col).alias("doc_id"), _text_key(F.col(text_col)).alias("key")).alias("__who"))
    rows = rows.groupBy("__who").agg(F.any_value("__d").alias("__d"))
    return rows.join(chosen, "__who", "left_semi").select("__d.*")
