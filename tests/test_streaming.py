import json
import os
import time

from conftest import reading
from fleetpulse.session import scratch_path
from fleetpulse.sources.layers import BRONZE_SCHEMA, read_layer
from fleetpulse.streaming.daily_counts import read_daily_counts, start_daily_counts
from fleetpulse.streaming.ingest import start_stream_ingest
from fleetpulse.streaming.prev_delta import compact_prev_delta, read_prev_delta, start_stream_prev_delta


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _drop(dir_, name, rows):
    os.makedirs(dir_, exist_ok=True)
    tmp = os.path.join(dir_, "." + name)
    with open(tmp, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    os.rename(tmp, os.path.join(dir_, name))   # files appear atomically
    time.sleep(0.05)


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def test_stream_ingest_exactly_once_and_dedupe(spark):
    src = scratch_path(spark, "src")
    out, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    _drop(_local(src), "a.json", [reading(event_id="a"), reading(event_id="a"), reading(event_id="b")])
    _run(start_stream_ingest(spark, src, out, ckpt))
    _run(start_stream_ingest(spark, src, out, ckpt))             # same files: nothing new
    _drop(_local(src), "b.json", [reading(event_id="b"), reading(event_id="c")])   # late duplicate of b
    _run(start_stream_ingest(spark, src, out, ckpt))
    got = sorted(r.event_id for r in read_layer(spark, out, BRONZE_SCHEMA).collect())
    assert got == ["a", "b", "c"]


def test_state_drops_recent_copies_and_the_index_older_ones(spark):
    src = scratch_path(spark, "src")
    out, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    first = [reading(event_id=f"e{k}", timestamp="2020-01-01 00:00:00") for k in range(6)]
    dropped, late = [], []
    for name, rows, pause in (("a.json", first, 0), ("b.json", [*first, reading(event_id="new")], 0),
                              ("c.json", [reading(event_id="other")], 3), ("d.json", [*first, reading(event_id="e0", rpm=7.0)], 3)):
        time.sleep(pause)
        _drop(_local(src), name, rows)
        q = start_stream_ingest(spark, src, out, ckpt, state_lifetime="2 seconds")
        _run(q)
        state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
        dropped.append(sum(s["customMetrics"]["numDroppedDuplicateRows"] for s in state))
        late.append(sum(s["numRowsDroppedByWatermark"] for s in state))
        assert any("rocksdb" in k.lower() for k in state[-1]["customMetrics"])
    assert dropped[1] == 6 and late == [0, 0, 0, 0]      # within the lifetime: the state; old event times are never late
    assert dropped[3] == 0                               # beyond it: the exact way
    got = sorted(r.event_id for r in read_layer(spark, out, BRONZE_SCHEMA).collect())
    assert got == sorted([*(f"e{k}" for k in range(6)), "new", "other"])
    # a new checkpoint reads all files again: nothing is added
    _run(start_stream_ingest(spark, src, out, scratch_path(spark, "ckpt")))
    assert read_layer(spark, out, BRONZE_SCHEMA).count() == 8


def test_stream_daily_counts_update_versions(spark):
    src = scratch_path(spark, "src")
    out, ckpt = scratch_path(spark, "daily"), scratch_path(spark, "ckpt")
    _drop(_local(src), "1.json", [reading(event_id="a", timestamp="2024-01-01 10:00:00", nox_ppm=400.0)])
    _run(start_daily_counts(spark, src, out, ckpt))
    _drop(_local(src), "2.json", [reading(event_id="b", timestamp="2024-01-01 11:00:00"),
                                  reading(event_id="c", timestamp="2024-01-02 01:00:00", is_anomaly=True)])
    _run(start_daily_counts(spark, src, out, ckpt))
    got = {(r.event_date, r.equipment_id): (r.total_readings, r.total_anomalies, r.nox_violations)
           for r in read_daily_counts(spark, out).collect()}
    assert got == {("2024-01-01", "EQ-001"): (2, 0, 1), ("2024-01-02", "EQ-001"): (0 + 1, 1, 0)}


def test_stream_prev_delta_corrects_late_rows(spark):
    src = scratch_path(spark, "src")
    out, state, ckpt = scratch_path(spark, "out"), scratch_path(spark, "state"), scratch_path(spark, "ckpt")
    batches = [[reading(event_id="a", timestamp="2024-01-01 10:00:00", rpm=1000.0),
                reading(event_id="b", timestamp="2024-01-01 10:00:05", rpm=1100.0),
                reading(event_id="x", equipment_id="EQ-002", timestamp="2024-01-01 10:00:00", rpm=500.0)],
               [reading(event_id="c", timestamp="2024-01-01 10:00:09", rpm=1300.0),
                reading(event_id="z", timestamp="2023-12-01 09:00:00", rpm=900.0),                  # a month late
                reading(event_id="b", timestamp="2024-01-01 10:00:05", rpm=1100.0),                 # re-sent
                reading(event_id="y", equipment_id="EQ-002", timestamp="2024-01-01 10:00:01", rpm=700.0)],
               [reading(event_id="m", timestamp="2024-01-01 10:00:07", rpm=1200.0)]]
    for k, rows in enumerate(batches):
        _drop(_local(src), f"{k}.json", rows)
        _run(start_stream_prev_delta(spark, src, out, state, ckpt))
    got = {r.event_id: (r.rpm_prev, r.rpm_delta) for r in read_prev_delta(spark, out).collect()}
    assert got == {"z": (None, None), "a": (900.0, 100.0), "b": (1000.0, 100.0), "m": (1100.0, 100.0), "c": (1200.0, 100.0),
                   "x": (None, None), "y": (500.0, 200.0)}
    before = sorted(map(tuple, read_prev_delta(spark, out).collect()))
    assert compact_prev_delta(spark, out) == 1
    assert sorted(map(tuple, read_prev_delta(spark, out).collect())) == before


def test_prev_delta_reads_only_the_days_around_late_rows(spark):
    """Random arrival over many days: equal to one batch, and the stored rows
    read are those of the late rows' own machines and days."""
    import random

    from conftest import to_df
    from fleetpulse.operators.enrich import add_prev_and_delta
    from fleetpulse.streaming import prev_delta as K
    src = scratch_path(spark, "src")
    out, state, ckpt = scratch_path(spark, "out"), scratch_path(spark, "state"), scratch_path(spark, "ckpt")
    rng = random.Random(3)
    rows = [reading(event_id=f"e{k}", equipment_id=rng.choice(["EQ-1", "EQ-2", None]), rpm=float(rng.randrange(700, 2000)),
                    timestamp="not a time" if k % 19 == 0 else f"2024-01-{rng.randrange(1, 9):02} {rng.randrange(24):02}:00:{rng.randrange(60):02}")
            for k in range(60)]
    for k in range(3):
        _drop(_local(src), f"{k}.json", rows[20 * k:20 * (k + 1)] + rows[:3])
        _run(start_stream_prev_delta(spark, src, out, state, ckpt))
        if k == 1:
            assert compact_prev_delta(spark, out) is None
    columns = ["event_id", "rpm_prev", "rpm_delta", "temp_coolant_prev"]
    result = lambda df: sorted(map(repr, df.select(*columns).collect()))
    want = result(add_prev_and_delta(K.clean_batch(to_df(spark, rows))))
    assert result(read_prev_delta(spark, out)) == want
    assert compact_prev_delta(spark, out) == 1 and result(read_prev_delta(spark, out)) == want
    # one late row: a plan that names its day, and rows of its machine only
    versions = K.read_versions(spark, out, schema=K.OUT_SCHEMA)
    bounds = K.merge_boundaries(K.read_versions(spark, state))
    late = K.with_day(K.clean_batch(to_df(spark, [reading(event_id="late", equipment_id="EQ-1", timestamp="2024-01-03 00:00:00")])))
    near = K.around(late, bounds)
    got = K.stored_rows(versions, near)
    assert {(r.equipment_id, str(r.timestamp)[:10]) for r in got.collect()} == {("EQ-1", "2024-01-03")}
    assert "PartitionFilters: [_day" in got._jdf.queryExecution().toString().replace("isnotnull(_day#", "_day#")
    on_time = K.with_day(K.clean_batch(to_df(spark, [reading(event_id="on time", equipment_id="EQ-1", timestamp="2025-01-01 00:00:00")])))
    assert K.stored_rows(versions, K.around(on_time, bounds)) is None


def test_late_rows_reach_bronze_and_the_counts(spark):
    src = scratch_path(spark, "src")
    bronze, out = scratch_path(spark, "bronze"), scratch_path(spark, "daily")
    ckpts = scratch_path(spark, "ckpt"), scratch_path(spark, "ckpt")
    for k, stamp in enumerate(["2024-03-01 10:00:00", "2024-01-01 10:00:00"]):
        _drop(_local(src), f"{k}.json", [reading(event_id=f"e{k}", timestamp=stamp), {}, {"rpm": "x"}])
        _run(start_stream_ingest(spark, src, bronze, ckpts[0]))
        _run(start_daily_counts(spark, src, out, ckpts[1]))
    assert sorted(r.event_id for r in read_layer(spark, bronze, BRONZE_SCHEMA).collect()) == ["e0", "e1"]
    assert spark.read.parquet(bronze + "_quarantine").count() == 4
    assert {r.event_date: r.total_readings for r in read_daily_counts(spark, out).collect()} == {"2024-03-01": 1, "2024-01-01": 1}


def test_stream_daily_kpis_equal_batch_gold_across_batches(spark):
    from pyspark.sql import functions as F

    from conftest import to_df
    from fleetpulse.plans.gold import build_gold
    from fleetpulse.plans.silver import build_silver
    from fleetpulse.streaming.daily_kpis import read_daily_kpis, start_daily_kpis
    src = scratch_path(spark, "src")
    out, ckpt = scratch_path(spark, "kpis"), scratch_path(spark, "ckpt")
    b1 = [reading(event_id="a", timestamp="2024-01-01 10:00:00", rpm=1000.0, nox_ppm=360.0, is_anomaly=True),
          reading(event_id="b", timestamp="2024-01-01 11:00:00", rpm=1500.5, fuel_rate_lh=12.34)]
    b2 = [reading(event_id="b", timestamp="2024-01-01 11:00:00", rpm=1500.5, fuel_rate_lh=12.34),  # re-sent
          reading(event_id="c", timestamp="2024-01-01 12:00:00", rpm=700.0, temp_coolant_c=107.0),
          reading(event_id="d", timestamp="2024-01-02 01:00:00", ingestion_date="2024-01-02", rpm=9000.0)]
    _drop(_local(src), "1.json", b1)
    _run(start_daily_kpis(spark, src, out, ckpt))
    _drop(_local(src), "2.json", b2)
    _run(start_daily_kpis(spark, src, out, ckpt))
    got = read_daily_kpis(spark, out)
    want = build_gold(build_silver(to_df(spark, b1 + b2), with_lag=False))
    cols = want.columns
    assert got.select(*cols).exceptAll(want).count() == 0 and want.exceptAll(got.select(*cols)).count() == 0
    assert got.filter(F.col("ingestion_date") == "2024-01-01").first().total_readings == 3


def test_compaction_keeps_reader_result(spark, monkeypatch):
    from fleetpulse.streaming import versions
    from fleetpulse.streaming.daily_counts import compact_daily_counts
    src = scratch_path(spark, "src")
    out, ckpt = scratch_path(spark, "daily"), scratch_path(spark, "ckpt")

    def add(i, day):
        _drop(_local(src), f"{i}.json", [reading(event_id=f"e{i}", timestamp=f"2024-01-{day} 10:00:0{i}")])
        _run(start_daily_counts(spark, src, out, ckpt))

    read = lambda: sorted(tuple(r) for r in read_daily_counts(spark, out).collect())
    for i, day in enumerate(["01", "01", "02", "01"]):
        add(i, day)
    before = read()
    # a crash after the merged rows are written and before they are published
    fs = versions._fs
    monkeypatch.setattr(versions, "_fs", lambda s, p: 1 / 0 if "_published/gen" in p else fs(s, p))
    try:
        compact_daily_counts(spark, out)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert versions.published(spark, out) == (0, -1) and read() == before
    # a crash after publishing and before old files are deleted
    monkeypatch.setattr(versions, "_delete", lambda *a: 1 / 0)
    assert compact_daily_counts(spark, out) == 1             # nothing old to delete yet
    monkeypatch.undo()
    assert versions.published(spark, out)[0] == 1 and read() == before
    for i, day in ((4, "02"), (5, "02"), (6, "01")):
        add(i, day)
    after = read()
    monkeypatch.setattr(versions, "_delete", lambda *a: 1 / 0)
    try:
        compact_daily_counts(spark, out)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert versions.published(spark, out)[0] == 2 and read() == after
    add(7, "03")
    add(8, "03")
    assert compact_daily_counts(spark, out) == 3
    assert {r.event_date: r.total_readings for r in read_daily_counts(spark, out).collect()} == {
        "2024-01-01": 4, "2024-01-02": 3, "2024-01-03": 2}
