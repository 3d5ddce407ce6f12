"""An index of stored ingest keys, so that an append reads a few buckets of keys instead
of the id column of the whole store.

The index lies beside the store as segments. A segment covers some data files of the
store; its keys are dealt over hash buckets of about ``KEYS_PER_BUCKET`` keys,
and every bucket has a Bloom filter: 64-bit words, each key sets ``BITS_SET`` bits of
one word. A batch's keys are tested against the words of the buckets they fall into;
only buckets with a possible hit have their keys read, and joined exactly, so a false
positive costs a read and changes nothing.

Crash safety: a segment counts once its marker folder exists, created after its
files. ``refresh`` lists the store and indexes the files that no segment covers, so what an
append stored before it died is found by the next one. If a covered file is gone the
store was rewritten: the index is built anew. Segments of one size class are folded
into one when there are ``FAN`` of them, so a key is rewritten a logarithmic
number of times and a probe sees few segments. One writer at a time, like the store.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .writers import INGEST_KEY, remove_path

BESIDE = "_ids"
KEYS_PER_BUCKET = 1_000_000
BITS_PER_KEY = 16
BITS_SET = 4
FAN = 4
#: A batch with at least a quarter of the stored keys is joined with all of them: most buckets
#: would be read anyway, and the Bloom words test every key once more for every segment.
STORED_PER_KEY = 4


@dataclass(frozen=True)
class Segment:
    number: int
    keys: int
    buckets: int
    words: int      # Bloom words of a bucket

    @property
    def name(self) -> str:
        return f"seg={self.number},keys={self.keys},buckets={self.buckets},words={self.words}"

    @property
    def size_class(self) -> int:
        size, out = self.keys, 0
        while size >= FAN:
            size, out = size // FAN, out + 1
        return out


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def data_files(spark: SparkSession, store: str) -> list[str]:
    """The store's data files, relative to it (Spark's own listing)."""
    fs, root = _fs(spark, store)
    if not fs.exists(root):
        return []
    plain = lambda uri: re.sub(r"^(\w+):/+", r"\1:/", uri)
    prefix = plain(fs.makeQualified(root).toString()).rstrip("/") + "/"
    found = spark.read.schema("_ int").parquet(store).inputFiles()
    return sorted(plain(unquote(uri)).removeprefix(prefix) for uri in found)


def segments(spark: SparkSession, index: str) -> list[Segment]:
    """The published segments in force: a fold's marker names what it replaces."""
    fs, root = _fs(spark, f"{index}/_published")
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    gone = {int(n) for name in names for n in re.findall(r"\d+", name.partition(",over=")[2])}
    found = [re.match(r"seg=(\d+),keys=(\d+),buckets=(\d+),words=(\d+)", n) for n in names]
    return sorted((Segment(*map(int, m.groups())) for m in found if m and int(m[1]) not in gone), key=lambda s: s.number)


def _hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), F.col(INGEST_KEY))


def _mask() -> Column:
    """``BITS_SET`` bits of a word."""
    out = F.lit(0).cast("long")
    for k in range(BITS_SET):
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(_hash(3 + k), F.lit(64)).cast("int")))
    return out


def _next_number(spark: SparkSession, index: str) -> int:
    fs, root = _fs(spark, f"{index}/_published")
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return max((int(re.match(r"seg=(\d+)", n)[1]) for n in names), default=0) + 1


def _write_segment(spark: SparkSession, index: str, keys: DataFrame, files: DataFrame, over: list[Segment] = (),
                   keys_per_bucket: int = KEYS_PER_BUCKET) -> Segment:
    """Write the distinct keys and the covered files, then publish."""
    staging = scratch_path(spark, "id-index")
    number = _next_number(spark, index)
    try:
        keys.select(INGEST_KEY).distinct().write.parquet(staging)
        keys = spark.read.parquet(staging)
        n = keys.count()
        buckets = max(1, -(-n // keys_per_bucket))
        segment = Segment(number, n, buckets, max(1, -(-n * BITS_PER_KEY // (64 * buckets))))
        keys = keys.withColumn("bucket", F.pmod(_hash(1), F.lit(buckets)).cast("int"))
        (keys.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{index}/keys/seg={number}"))
        words = keys.groupBy("bucket", F.pmod(_hash(2), F.lit(segment.words)).alias("word")).agg(F.bit_or(_mask()).alias("bits"))
        (words.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{index}/words/seg={number}"))
    finally:
        remove_path(spark, staging)
    files.coalesce(1).write.mode("overwrite").parquet(f"{index}/files/seg={number}")
    replaced = ",over=" + "-".join(str(s.number) for s in over) if over else ""
    fs, marker = _fs(spark, f"{index}/_published/{segment.name}{replaced}")
    if not fs.mkdirs(marker):
        raise OSError(f"could not publish {marker}")
    for old in over:
        for kind in ("keys", "words", "files"):
            remove_path(spark, f"{index}/{kind}/seg={old.number}")
    return segment


_SCHEMAS = {"keys": f"{INGEST_KEY} string, seg int, bucket int", "words": "word long, bits long, seg int, bucket int",
            "files": "file string, seg int"}


def _read(spark: SparkSession, index: str, kind: str, paths: list[str]) -> DataFrame:
    return (spark.read.schema(_SCHEMAS[kind]).option("basePath", f"{index}/{kind}")
            .parquet(*[f"{index}/{kind}/{p}" for p in paths]))


def covered(spark: SparkSession, index: str) -> set[str]:
    """The files (or other units) that the published segments cover."""
    live = segments(spark, index)
    rows = _read(spark, index, "files", [f"seg={s.number}" for s in live]).select("file").collect() if live else []
    return {r[0] for r in rows}


def cover(spark: SparkSession, index: str, units: list[str], read_keys: Callable[[list[str]], DataFrame],
          keys_per_bucket: int = KEYS_PER_BUCKET) -> None:
    """Add a segment that covers ``units``, and fold segments of one size class."""
    if units:
        _write_segment(spark, index, read_keys(units), spark.createDataFrame([(u,) for u in units], "file string"),
                       keys_per_bucket=keys_per_bucket)
    while True:
        by_class: dict[int, list[Segment]] = {}
        for s in segments(spark, index):
            by_class.setdefault(s.size_class, []).append(s)
        fold = next((v for v in by_class.values() if len(v) >= FAN), None)
        if fold is None:
            return
        paths = [f"seg={s.number}" for s in fold]
        _write_segment(spark, index, _read(spark, index, "keys", paths), _read(spark, index, "files", paths).select("file"),
                       fold, keys_per_bucket)


def refresh(spark: SparkSession, store: str, index: str, read_keys: Callable[[list[str]], DataFrame],
            keys_per_bucket: int = KEYS_PER_BUCKET) -> dict:
    """Bring the index up to the store's files. ``read_keys`` gives the ingest
    keys of some files. Returns how many files were read, and whether the
    index was built anew."""
    stored, known = data_files(spark, store), covered(spark, index)
    anew = not known <= set(stored)
    if anew:
        remove_path(spark, f"{index}/_published")   # first: without markers the rest is not read
        remove_path(spark, index)
        known = set()
    new = [f for f in stored if f not in known]
    cover(spark, index, new, lambda files: read_keys([f"{store.rstrip('/')}/{f}" for f in files]), keys_per_bucket)
    return {"files_read": len(new), "rebuilt": anew}


def mark_unique(spark: SparkSession, index: str, unique: bool) -> None:
    """Note that every key of the store is stored once (it was only ever appended
    to through this index, from empty), or that it may not be."""
    if not unique:
        remove_path(spark, f"{index}/_unique")
        return
    fs, marker = _fs(spark, f"{index}/_unique")
    if not fs.mkdirs(marker):
        raise OSError(f"could not write {marker}")


def is_unique(spark: SparkSession, store: str, index: str) -> bool:
    """Whether every key is known to be stored once: it is marked so, and
    no file that the index covers is gone (which a rewrite would leave)."""
    fs, marker = _fs(spark, f"{index}/_unique")
    return fs.exists(marker) and covered(spark, index) <= set(data_files(spark, store))


def _filled(spark: SparkSession, index: str, live: list[Segment], kind: str) -> set[str]:
    """The bucket folders of the segments; a bucket may have got no key."""
    out = set()
    for s in live:
        fs, root = _fs(spark, f"{index}/{kind}/seg={s.number}")
        out |= {f"seg={s.number}/{st.getPath().getName()}" for st in fs.listStatus(root) if st.isDirectory()}
    return out


def seen_keys(spark: SparkSession, batch: DataFrame, index: str, read: dict | None = None,
              distinct: bool = False) -> DataFrame:
    """The batch's ingest keys that the index holds, exactly. ``read`` gets
    the numbers of bucket folders read (at most the batch's keys times the
    segments, however large the store). ``distinct``: the batch is staged and holds every key once."""
    live = segments(spark, index)
    keys = batch.select(INGEST_KEY)
    none = spark.createDataFrame([], keys.schema)
    read = {} if read is None else read
    read |= {"word_buckets": 0, "key_buckets": 0}
    if not live:
        return none
    if not distinct:
        path = scratch_path(spark, "id-batch")
        keys.distinct().write.parquet(path)
        keys = spark.read.schema(keys.schema).parquet(path)
    if sum(s.keys for s in live) <= STORED_PER_KEY * keys.count():
        possible = sorted(_filled(spark, index, live, "keys"))
        read |= {"key_buckets": len(possible)}
        if not possible:
            return none
        return keys.join(_read(spark, index, "keys", possible).select(INGEST_KEY), INGEST_KEY, "left_semi")
    at = F.explode(F.array(*[F.struct(F.lit(s.number).alias("seg"), F.lit(s.buckets).alias("buckets"), F.lit(s.words).alias("words"))
                             for s in live])).alias("s")
    probes = keys.select(INGEST_KEY, at).select(
        INGEST_KEY, "s.seg", F.pmod(_hash(1), F.col("s.buckets")).cast("int").alias("bucket"),
        F.pmod(_hash(2), F.col("s.words")).alias("word"), _mask().alias("mask"))
    staged = scratch_path(spark, "id-probes")
    probes.write.parquet(staged)
    probes = spark.read.schema(probes.schema).parquet(staged)

    filled = _filled(spark, index, live, "words")

    def folders(df: DataFrame) -> list[str]:
        # bounded by the number of buckets, not of keys
        pairs = df.select("seg", "bucket").distinct().collect()
        return sorted(filled & {f"seg={r[0]}/bucket={r[1]}" for r in pairs})

    asked = folders(probes)
    if not asked:
        return none
    words = _read(spark, index, "words", asked)
    on = ["seg", "bucket", "word"]
    hits = probes.join(words, on).filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select(INGEST_KEY, "seg", "bucket")
    hit_path = scratch_path(spark, "id-hits")
    hits.write.parquet(hit_path)
    hits = spark.read.schema(hits.schema).parquet(hit_path)
    possible = folders(hits)
    read |= {"word_buckets": len(asked), "key_buckets": len(possible)}
    if not possible:
        return none
    stored = _read(spark, index, "keys", possible)
    return hits.join(stored, [INGEST_KEY, "seg", "bucket"], "left_semi").select(INGEST_KEY).distinct()
