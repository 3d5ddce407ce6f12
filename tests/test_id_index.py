"""The index of stored ingest keys: exact answers, few reads, crashes."""

import pytest
from pyspark.sql import functions as F

from fleetpulse.constants import SENSOR_SCHEMA
from fleetpulse.plans.bronze import append_batch
from fleetpulse.sinks import id_index as I
from fleetpulse.sinks.writers import INGEST_KEY, remove_path

from conftest import reading


def store_keys(spark, path, ids, mode="append"):
    spark.createDataFrame([(i,) for i in ids], f"{INGEST_KEY} string").write.mode(mode).parquet(path)


def reader(spark, seen=None):
    def read(files):
        if seen is not None:
            seen.append(len(files))
        return spark.read.parquet(*files)
    return read


def probe(spark, index, ids, read=None):
    batch = spark.createDataFrame([(i,) for i in ids], f"{INGEST_KEY} string")
    return sorted(r[0] for r in I.seen_keys(spark, batch, index, read).collect())


def test_exact_and_few_buckets_read(spark, tmp_dir):
    store, index = f"{tmp_dir}/store", f"{tmp_dir}/ids"
    assert probe(spark, index, ["a"]) == []
    reads = []
    for size in (2000, 20_000):
        store_keys(spark, store, [f"E-{size}-{k}" for k in range(size)])
        I.refresh(spark, store, index, reader(spark, reads), keys_per_bucket=200)
        read = {}
        assert probe(spark, index, [f"E-{size}-7", "new-1", "new-2"], read) == [f"E-{size}-7"]
        # three ids ask three buckets a segment, whatever the store holds, and read about one
        assert read["word_buckets"] <= 3 * len(I.segments(spark, index)) and read["key_buckets"] <= 3
    assert I.refresh(spark, store, index, reader(spark, reads)) == {"files_read": 0, "rebuilt": False}
    ids = [f"E-2000-{k}" for k in range(0, 2000, 50)] + [f"no-{k}" for k in range(500)]
    assert probe(spark, index, ids) == sorted(i for i in ids if i.startswith("E-"))


def test_segments_are_folded(spark, tmp_dir):
    store, index = f"{tmp_dir}/store", f"{tmp_dir}/ids"
    for k in range(9):
        store_keys(spark, store, [f"{k}-{j}" for j in range(50)])
        I.refresh(spark, store, index, reader(spark), keys_per_bucket=30)
    live = I.segments(spark, index)
    assert len(live) < 6 and sum(s.keys for s in live) == 450
    assert probe(spark, index, [f"{k}-7" for k in range(10)]) == [f"{k}-7" for k in range(9)]


def test_crash_before_the_marker_and_a_rewritten_store(spark, tmp_dir):
    store, index = f"{tmp_dir}/store", f"{tmp_dir}/ids"
    store_keys(spark, store, ["a", "b"])
    I.refresh(spark, store, index, reader(spark))
    # files of a segment without a marker: what a crash leaves
    store_keys(spark, store, ["c"])
    store_keys(spark, f"{index}/keys/seg=2/bucket=0", ["ghost"])
    assert probe(spark, index, ["a", "c", "ghost"]) == ["a"]
    uncovered = len(I.data_files(spark, store)) - len(I.covered(spark, index))
    assert I.refresh(spark, store, index, reader(spark)) == {"files_read": uncovered, "rebuilt": False}
    assert probe(spark, index, ["a", "c", "ghost"]) == ["a", "c"]
    store_keys(spark, store, ["x"], mode="overwrite")
    assert I.refresh(spark, store, index, reader(spark))["rebuilt"]
    assert probe(spark, index, ["a", "c", "x"]) == ["x"]


@pytest.mark.parametrize("lost", ["index", "markers", "nothing"])
def test_append_after_a_crash(spark, tmp_dir, lost):
    """The same records again add nothing, whatever became of the index."""
    rows = [reading(event_id=f"E-{k}") for k in range(20)] + [reading(event_id=None, rpm=float(k)) for k in range(3)]
    bronze = f"{tmp_dir}/bronze"
    names = SENSOR_SCHEMA.fieldNames()
    batch = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], "struct<" + ",".join(
        f"{f.name}:{f.dataType.simpleString()}" for f in SENSOR_SCHEMA.fields) + ">")
    batch = batch.withColumn("_corrupt_record", F.lit(None).cast("string")).withColumn("_src", F.lit("f"))
    assert append_batch(spark, batch, bronze, None)["rows_written"] == 23
    assert append_batch(spark, batch, bronze, None)["rows_written"] == 0
    if lost != "nothing":
        remove_path(spark, bronze + I.BESIDE + ("/_published" if lost == "markers" else ""))
    assert append_batch(spark, batch, bronze, None)["rows_written"] == 0
    assert spark.read.parquet(bronze).count() == 23
