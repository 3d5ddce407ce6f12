"""K2 by event-time windows: late rows, state that goes, restarts, compaction."""

import random

from conftest import reading, to_df
from fleetpulse.session import scratch_path
from fleetpulse.streaming import windowed_counts as K
from fleetpulse.streaming.daily_counts import daily_counts_plan
from test_streaming import _drop, _local, _run

COLUMNS = [*K.DAILY_KEYS, *K.COUNTS]


def table(df):
    return sorted(map(repr, df.select(*COLUMNS).collect()))


def test_rows_of_closed_windows_go_to_the_side_table(spark):
    src, out, ckpt = (scratch_path(spark, p) for p in ("src", "windows", "ckpt"))
    assert table(K.read_windowed_counts(spark, out)) == []
    batches = [[reading(event_id="a", timestamp="2024-01-01 10:00:00", nox_ppm=400.0),
                reading(event_id="n", timestamp="2024-01-01 10:00:00", equipment_id=None)],
               [reading(event_id="b", timestamp="2024-01-02 23:59:59")],
               [reading(event_id="c", timestamp="2024-01-01 11:00:00", is_anomaly=True)],       # late, window still open
               [reading(event_id="d", timestamp="2024-02-01 00:00:00")],
               [reading(event_id="e", timestamp="2024-02-01 01:00:00")],
               [reading(event_id="f", timestamp="2024-01-01 12:00:00", temp_coolant_c=106.0),   # windows are closed
                reading(event_id="m", timestamp="2024-01-01 12:00:00", equipment_id=None),
                reading(event_id="g", timestamp="no time"), reading(event_id="h", timestamp="2024-02-01 02:00:00"), {}]]
    state = []
    for k, rows in enumerate(batches):
        _drop(_local(src), f"{k}.json", rows)
        q = K.start_windowed_counts(spark, src, out, ckpt, delay="1 day")      # every call restarts from the checkpoint
        _run(q)
        state.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1])
    assert state[1] == 3 and state[-1] == 1        # closed windows leave the state
    windows = {(r.event_date, r.equipment_id): tuple(r[2:]) for r in K.read_windows(spark, out).collect()}
    assert windows == {("2024-01-01", "EQ-001"): (2, 1, 1, 0), ("2024-01-01", None): (1, 0, 0, 0),
                       ("2024-01-02", "EQ-001"): (1, 0, 0, 0), ("2024-02-01", "EQ-001"): (3, 0, 0, 0)}
    late = {(r.event_date, r.equipment_id): tuple(r[2:]) for r in K.read_late(spark, out).collect()}
    assert late == {("2024-01-01", "EQ-001"): (1, 0, 0, 1), ("2024-01-01", None): (1, 0, 0, 0), (None, "EQ-001"): (1, 0, 0, 0)}
    want = table(daily_counts_plan(to_df(spark, [r for rows in batches for r in rows if r])))
    assert table(K.read_windowed_counts(spark, out)) == want
    assert K.compact_windowed_counts(spark, out) == (1, 1)
    assert table(K.read_windowed_counts(spark, out)) == want


def test_any_order_of_arrival_counts_every_row_once(spark):
    src, out, ckpt = (scratch_path(spark, p) for p in ("src", "windows", "ckpt"))
    rng = random.Random(5)
    rows = [reading(event_id=f"e{k}" if k % 9 else None, equipment_id=rng.choice(["EQ-1", "EQ-2", None]),
                    is_anomaly=rng.choice([True, False, None]), nox_ppm=rng.choice([None, 349.0, 351.0]),
                    timestamp="broken" if k % 13 == 0 else f"2024-01-{rng.randrange(1, 13):02} {rng.randrange(24):02}:30:00")
            for k in range(80)]
    for k in range(8):
        _drop(_local(src), f"{k}.json", rows[10 * k:10 * (k + 1)])
    _run(K.start_windowed_counts(spark, src, out, ckpt, delay="1 hour", max_files_per_trigger=1))
    assert K.read_late(spark, out).filter("event_date IS NOT NULL").count() > 0
    assert table(K.read_windowed_counts(spark, out)) == table(daily_counts_plan(to_df(spark, rows)))


def test_a_retried_batch_changes_nothing(spark, monkeypatch):
    """The driver dies between the two tables of a micro-batch."""
    src, out, ckpt = (scratch_path(spark, p) for p in ("src", "windows", "ckpt"))
    rows = [reading(event_id="a", timestamp="2024-01-01 10:00:00"), reading(event_id="b", timestamp="x")]
    _drop(_local(src), "0.json", rows)
    write = K.write_batch
    monkeypatch.setattr(K, "write_batch", lambda df, path, n: 1 / 0 if path.endswith("/late") else write(df, path, n))
    q = K.start_windowed_counts(spark, src, out, ckpt)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None
    monkeypatch.undo()
    _run(K.start_windowed_counts(spark, src, out, ckpt))
    assert table(K.read_windowed_counts(spark, out)) == table(daily_counts_plan(to_df(spark, rows)))
