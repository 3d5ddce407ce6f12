"""What a micro-batch costs: files by the folders it writes to, batches by the rows of the input."""

import os

import pytest
from conftest import SMOKE, reading, to_df
from fleetpulse import queries as Q
from fleetpulse.session import scratch_path
from fleetpulse.streaming.ingest import start_stream_ingest


def parquet_files(path):
    return [f for d, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet")]


@pytest.fixture()
def src(spark):
    path = scratch_path(spark, "json-batches")
    to_df(spark, [reading(event_id=f"E-{k}") for k in range(200)]).coalesce(1).write.json(path)
    return path


def test_a_micro_batch_writes_one_file_into_a_small_folder(spark, src):
    out = scratch_path(spark, "bronze")
    Q._run(start_stream_ingest(spark, src, out, scratch_path(spark, "ckpt")))
    assert spark.read.parquet(out).count() == 200
    assert len(parquet_files(out)) == 1     # one date, one type; not one for every task of the shuffle


def test_files_of_a_stream_follow_its_rows_not_the_tasks(spark, monkeypatch):
    rows = spark.range(1000, numPartitions=7)
    assert Q._in_stream_files(rows, 1000).rdd.getNumPartitions() == 1
    monkeypatch.setattr(Q, "STREAM_FILE_ROWS", 300)
    assert Q._in_stream_files(rows, 1000).rdd.getNumPartitions() == 4
    assert Q._in_stream_files(rows, 0).rdd.getNumPartitions() == 1


def test_a_stream_has_a_file_for_a_small_stretch_however_many_tasks_read_it(spark):
    src = scratch_path(spark, "events-parts")
    spark.read.parquet(f"{SMOKE}/events.parquet").repartition(6).write.parquet(f"{src}/events.parquet")
    for junk in (False, True):
        root = Q._stage_stream(spark, src, junk).removesuffix("/*").removeprefix("file:")
        assert [sum(f.startswith("part-") for f in os.listdir(f"{root}/{k}")) for k in range(4)] == [1, 1, 1, 1]


def test_large_stretches_are_written_by_several_tasks_and_read_in_one_batch(spark, monkeypatch):
    assert Q._files_per_batch([2_000_000, 1_900_000, 1_900_000, 120_000]) == 8
    assert Q._files_per_batch([12_000_000, 12_000_000, 12_000_000, 700_000]) == 16
    assert Q._files_per_batch([2_000_000, 0, 10, 5]) == Q._files_per_batch([300, 300, 300, 20]) == 1
    assert Q._in_stream_files(spark.range(1000), 1000, 3).rdd.getNumPartitions() == 3
    whole = spark.read.json(Q._stage_stream(spark, SMOKE)).groupBy("event_id", "rpm", "timestamp").count()
    monkeypatch.setattr(Q, "_files_per_batch", lambda counts: 3)
    src, per_batch = Q._stage_batches(spark, SMOKE)
    assert per_batch == 3
    root = src.removesuffix("/*").removeprefix("file:")
    assert [sum(f.startswith("part-") for f in os.listdir(f"{root}/{k}")) for k in range(4)] == [3, 3, 3, 3]
    again = spark.read.json(src).groupBy("event_id", "rpm", "timestamp").count()
    assert whole.exceptAll(again).isEmpty() and again.exceptAll(whole).isEmpty()


def test_the_events_are_dealt_over_the_files_before_the_readings_are_derived(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "_in_stream_files", lambda rows, n, per_batch=1: seen.append(rows.columns) or rows)
    Q._stage_stream(spark, SMOKE)
    assert seen == [["event_id", "ts", "user_id", "event_type", "value", "props"]] * 4
