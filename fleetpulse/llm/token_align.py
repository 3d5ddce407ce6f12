"""Cross-tokenizer alignment over whitespace-token anchors.

Every text is encoded whole by a byte-level BPE (A, of a space and the text) and by a
SentencePiece model (B, of the text, which adds the space). Offsets where tokens of both
end and where the next token of both begins with a space are anchors. They split the
token sequences into windows of a few ids, and a window's alignment (its groups and its
overlapping id pairs) depends on its ids only, so it is worked out once a chunk and
looked up by the tuple of ids afterwards. An id pair's count is the number of links
of the whole corpus that hold it.

Scale: one Python pass encodes the texts, in chunks of about ``CHUNK_BYTES`` of text
that start with an empty memo, so memory is bounded by a chunk (or the longest text).
A chunk leaves its documents' windows as numbers and one dictionary row with its
windows' pairs. Pair counts are one partial aggregation over the dictionaries; only a
chunk's distinct pairs are joined with the counts, not the links, and meet the chunk's
documents in a cogroup. No text is shuffled or encoded twice, and no chunk is hot.

The vocabulary files are read by the driver and travel with the task (2 MB); A is run as
a rank-merging encoder made from the JSON file, whose merges are checked to be in the
order of their ids.

Defined results: NULL and empty texts, texts that are not UTF-8 and texts whose joined
token bytes differ from the space and the text have no tokens: zeros and ''. Repeated
rows and NULL ids are rows like others. Strings of special tokens are plain text. An
empty table gives an empty result. Only the id and the text are read; other columns
cannot clash. A very long text is one chunk.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stage

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 8_000_000     # text a memo is kept for
SLICE_BYTES = 500_000       # text encoded at a time; a longer text is a slice
#: FIXED VALUE: the split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CHUNK_BITS = 24


def _byte_alphabet() -> dict[str, int]:
    """The byte of every character of a byte-level vocabulary: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes_a(vocabulary: bytes) -> dict[int, bytes]:
    """The bytes of every entry; raises where merging by rank would differ
    from merging by the listed merges."""
    model = json.loads(vocabulary)["model"]
    ids = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(a >= b for a, b in zip(ids, ids[1:])):
        raise ValueError("the merges of the byte-level vocabulary are not in the order of their ids")
    alphabet = _byte_alphabet()
    return {i: bytes(alphabet[c] for c in token) for token, i in model["vocab"].items()}


class Encoders:
    """Both encoders and their tables of token bytes, lengths and space marks."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        import tiktoken
        table = token_bytes_a(a)
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={},
                                   mergeable_ranks={v: k for k, v in table.items()})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.bytes_a = [table.get(i, b"") for i in range(max(table) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        #: every id with a comma, a bar and a semicolon behind it
        self.written = [f"{i}{sign}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for sign in ",|;"]
        self.space_a, self.space_b = (np.array([t[:1] == b" " for t in x]) for x in (self.bytes_a, self.bytes_b))

    def encode(self, texts: list[bytes | None]) -> list[tuple[list[int], list[int]] | None]:
        """(A ids, B ids) of every text; None where it has no tokens."""
        plain, out = [], []
        for t in texts:
            try:
                plain.append(t.decode() if t else "")
            except UnicodeDecodeError:
                plain.append("")
        for text, b in zip(plain, self.b.encode(plain, num_threads=1)):
            whole = (" " + text).encode()
            a = self.a.encode_ordinary(" " + text) if text else []
            same = (text and b"".join(map(self.bytes_a.__getitem__, a)) == whole
                    and b"".join(map(self.bytes_b.__getitem__, b)) == whole)
            out.append((a, b) if same else None)
        return out


_ENCODERS: dict[str, Encoders] = {}


def encoders(a: bytes, b: bytes) -> Encoders:
    """Built once per worker process."""
    key = hashlib.sha256(a + b).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoders(a, b)
    return _ENCODERS[key]


class Memo:
    """The window alignments of one chunk, by the tuple of their ids. Texts that
    follow each other are read as one: both encoders begin every text with a
    space, so that its first tokens are an anchor."""

    def __init__(self, enc: Encoders):
        self.enc, self.number, self.text = enc, {}, []
        self.n_groups = self.n_links = np.zeros(0, np.int64)
        self.codes: list[np.ndarray] = []

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first tokens of all windows in a and in b, and their ends."""
        end_a, end_b = np.cumsum(self.enc.size_a[a]), np.cumsum(self.enc.size_b[b])
        at_a, at_b = np.flatnonzero(self.enc.space_a[a[1:]]) + 1, np.flatnonzero(self.enc.space_b[b[1:]]) + 1
        _, i, j = np.intersect1d(end_a[at_a - 1], end_b[at_b - 1], assume_unique=True, return_indices=True)
        return np.concatenate([[0], at_a[i], [len(a)]]), np.concatenate([[0], at_b[j], [len(b)]])

    def add(self, found: list[tuple[list[int], list[int]]]) -> list[np.ndarray]:
        """The numbers of every text's windows, in order."""
        a, b = (np.fromiter((i for f in found for i in f[k]), np.uint32) for k in range(2))
        starts_a, starts_b = self.windows(a, b)
        ids_a, ids_b, out, new = a.tobytes(), b.tobytes(), [], []
        at_a, at_b = (starts_a * 4).tolist(), (starts_b * 4).tolist()
        number = self.number
        for s, e, u, v in zip(at_a, at_a[1:], at_b, at_b[1:]):
            key = ids_a[s:e], ids_b[u:v]
            k = number.get(key)
            if k is None:
                k = number[key] = len(number)
                new.append(key)
            out.append(k)
        if new:
            self._align(new)
        firsts = np.cumsum([0, *(len(f[0]) for f in found[:-1])])
        return np.split(np.array(out), np.searchsorted(starts_a, firsts[1:]))

    def _align(self, keys: list[tuple[bytes, bytes]]) -> None:
        """Windows that are not known yet, all at once: both sides of a window
        have the same bytes, so offsets run on from window to window. Between two
        neighbouring ends, of whichever side, lies exactly one link."""
        a, b = (np.frombuffer(b"".join(k[side] for k in keys), np.uint32).astype(np.int64) for side in range(2))
        n_a, n_b = (np.array([len(k[side]) for k in keys]) // 4 for side in range(2))
        end_a, end_b = np.cumsum(self.enc.size_a[a]), np.cumsum(self.enc.size_b[b])
        window_ends = end_a[np.cumsum(n_a) - 1]
        both, cuts = np.intersect1d(end_a, end_b, assume_unique=True), np.union1d(end_a, end_b)
        self.codes.append(a[np.searchsorted(end_a, cuts)] << 32 | b[np.searchsorted(end_b, cuts)])
        inside = lambda ends: np.diff(np.searchsorted(ends, window_ends, "right"), prepend=0)
        self.n_groups = np.concatenate([self.n_groups, inside(both)])
        self.n_links = np.concatenate([self.n_links, inside(cuts)])
        # the ids in the order of groups, A before B, each with what follows it
        place = np.concatenate([2 * np.searchsorted(both, end_a), 2 * np.searchsorted(both, end_b) + 1])
        order = np.argsort(place, kind="stable")
        place = place[order]
        last = np.diff(place, append=-1) != 0
        sign = np.where(last, 1 + place % 2, 0)
        parts = list(map(self.enc.written.__getitem__, (3 * np.concatenate([a, b])[order] + sign).tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        self.text += ["".join(parts[s:e]) for s, e in zip([0, *ends], ends)]


def pack(numbers: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending window numbers with their counts; steps are small, so that
    the shuffle's compression leaves little of them."""
    return np.concatenate([np.diff(numbers, prepend=0), counts]).astype(np.uint32).tobytes()


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(packed, np.uint32)
    return np.cumsum(both[:len(both) // 2]), both[len(both) // 2:]


def _schema(id_type: pa.DataType) -> pa.Schema:
    """Rows of documents; a chunk's dictionary row has only the last three
    columns: its distinct pairs, their links, and the windows' sizes and pairs."""
    return pa.schema([
        ("chunk", pa.int64()), ("doc_id", id_type), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
        ("windows", pa.binary()), ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int64())),
        ("sizes", pa.binary())])


def _encode_task(a: bytes, b: bytes, id_type: pa.DataType, chunk_bytes: int, with_groups: bool):
    schema = _schema(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoders(a, b), TaskContext.get().partitionId()
        memo, size, chunk = Memo(enc), 0, part << _CHUNK_BITS
        total = np.zeros(0, np.int64)

        def dictionary() -> pa.RecordBatch:
            flat = np.concatenate([np.zeros(0, np.int64), *memo.codes])
            pairs, place = np.unique(flat, return_inverse=True)
            links = np.bincount(place, np.repeat(total, memo.n_links), len(pairs)).astype(np.int64)
            blob = np.concatenate([memo.n_links, place]).astype(np.uint32).tobytes()
            row = {"chunk": chunk, "pairs": pairs, "links": links, "sizes": blob, "n_a": len(memo.text)}
            return pa.RecordBatch.from_pylist([row], schema)

        def aligned(ids: pa.Array, texts: list[bytes | None]) -> pa.RecordBatch:
            nonlocal total
            found = enc.encode(texts)
            some = [f for f in found if f is not None]
            numbers = iter(memo.add(some) if some else [])
            total = np.concatenate([total, np.zeros(len(memo.text) - len(total), np.int64)])
            rows = []
            for f in found:
                if f is None:
                    rows.append((0, 0, 0, 0, "", "" if with_groups else None, b""))
                    continue
                at = next(numbers)
                text = "".join(map(memo.text.__getitem__, at.tolist()))[:-1]
                known, times = np.unique(at, return_counts=True)
                total[known] += times
                rows.append((len(f[0]), len(f[1]), int(memo.n_groups[at].sum()), int(memo.n_links[at].sum()),
                             hashlib.sha256(text.encode()).hexdigest(), text if with_groups else None, pack(known, times)))
            columns = dict(zip(schema.names[2:9], zip(*rows)))
            columns |= {"chunk": [chunk] * len(rows)}
            return pa.RecordBatch.from_arrays(
                [ids.cast(id_type) if f.name == "doc_id" else pa.array(columns[f.name], f.type) if f.name in columns
                 else pa.nulls(len(rows), f.type) for f in schema], schema=schema)

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            done = 0
            while done < batch.num_rows:
                part: list[bytes | None] = []
                more = 0
                while done + len(part) < batch.num_rows and (not part or more < min(SLICE_BYTES, chunk_bytes - size)):
                    part.append(texts[done + len(part)].as_py())
                    more += len(part[-1] or b"")
                yield aligned(ids.slice(done, len(part)), part)
                size, done = size + more, done + len(part)
                if size >= chunk_bytes:
                    yield dictionary()
                    memo, size, chunk = Memo(enc), 0, chunk + 1
                    total = np.zeros(0, np.int64)
        if size:
            yield dictionary()
    return run


def _score_task(schema: pa.Schema):
    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        is_doc = pa.compute.is_null(rows.column("sizes"))
        docs, blob = rows.filter(is_doc), rows.filter(pa.compute.invert(is_doc))
        counts, best = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, np.int64)
        at = found.column("i").to_numpy()
        counts[at] = found.column("n").to_numpy()
        best[at] = found.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = (np.zeros(docs.num_rows, np.int64) for _ in range(2))
        if found.num_rows:
            n_windows = blob.column("n_a")[0].as_py()
            both = np.frombuffer(blob.column("sizes")[0].as_py(), np.uint32)
            starts = np.concatenate([[0], np.cumsum(both[:n_windows - 1], dtype=np.int64)])
            per_count = np.add.reduceat(counts[both[n_windows:]], starts)
            per_best = np.add.reduceat(best[both[n_windows:]], starts)
            for k, packed in enumerate(docs.column("windows").to_pylist()):
                numbers, times = unpack(packed)
                n_best[k], count_sum[k] = per_best[numbers] @ times, per_count[numbers] @ times
        out = {c: docs.column(c) for c in schema.names if c in docs.column_names}
        out |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.Table.from_arrays([out[c] for c in schema.names], schema=schema)
    return run


def align_documents(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, id_col: str = "doc_id",
                    text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, with_groups: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b (tokens), n_groups, n_links,
    n_best (links whose pair is its B id's most frequent one), count_sum (the
    pairs' corpus counts over all links), groups_sha256, and groups
    (``a1,a2|b1;a3|b2,b3``) where asked for."""
    with open(a_path, "rb") as f:
        a = f.read()
    with open(b_path, "rb") as f:
        b = f.read()
    id_type = docs.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)
    kinds = (f"chunk long, doc_id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
             "groups_sha256 string, groups string, windows binary, pairs array<long>, links array<long>, sizes binary")
    rows = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
                 .mapInArrow(_encode_task(a, b, arrow_id, chunk_bytes, with_groups), kinds), "align-rows")
    entries = (rows.filter("sizes IS NOT NULL")
               .select(F.col("chunk").alias("of"), F.posexplode(F.arrays_zip("pairs", "links")).alias("i", "e"))
               .select("of", "i", F.col("e.pairs").alias("pair"), F.col("e.links").alias("links")))
    counts = entries.groupBy("pair").agg(F.sum("links").alias("n")).withColumn("b", F.expr("pair & 4294967295"))
    counts = stage(counts, "align-counts")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    values = counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    found = entries.join(values, "pair").select("of", "i", "n", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    names += ["groups"] * with_groups
    fields = {"doc_id": arrow_id, "groups_sha256": pa.string(), "groups": pa.string()}
    schema = pa.schema([(c, fields.get(c, pa.int64())) for c in names])
    types = {"doc_id": id_type.simpleString(), "groups_sha256": "string", "groups": "string"}
    return rows.drop("pairs", "links").groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(
        _score_task(schema), ", ".join(f"{c} {types.get(c, 'long')}" for c in names))
