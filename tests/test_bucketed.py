"""Tables bucketed by the ingest key: right rows, and no exchange for work on ids."""

import os
import uuid

from conftest import reading, to_df
from fleetpulse.constants import SENSOR_COLUMNS
from fleetpulse.session import scratch_path
from fleetpulse.sinks.bucketed import joined, new_rows, save_bucketed, unique_rows
from fleetpulse.sinks.writers import INGEST_KEY


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def save(spark, rows, **kw):
    name = f"bucketed_{uuid.uuid4().hex[:8]}"
    location = scratch_path(spark, "bucketed")
    save_bucketed(to_df(spark, rows), name, buckets=4, location=location, **kw)
    return name, location


def test_id_work_on_bucketed_tables_needs_no_exchange(spark):
    stored = [reading(event_id=f"e{k}", rpm=900.0 + k) for k in range(30)] + [reading(event_id=None, rpm=float(k)) for k in range(9)]
    batch = stored[20:] + [reading(event_id=f"n{k}") for k in range(5)] * 2 + [reading(event_id=None, rpm=77.0)] * 2
    (a, where), (b, _) = save(spark, stored), save(spark, batch)
    new = new_rows(spark, b, a)
    assert sorted((r.event_id or "", r.rpm) for r in new.collect()) == [("", 77.0), *[(f"n{k}", 1000.0) for k in range(5)]]
    both = joined(spark, b, a, ["rpm"]).select(INGEST_KEY)
    assert both.count() == 19
    counts = spark.table(b).groupBy(INGEST_KEY).count()
    for df in (new, unique_rows(spark, b), both, counts):
        assert "Exchange" not in plan(df), plan(df)
    assert len([n for n in os.listdir(where.removeprefix("file:")) if n.startswith("part-")]) <= 4      # a file a bucket


def test_unique_keeps_the_first_copy_and_empty_tables_work(spark):
    rows = [reading(event_id="a", timestamp="2024-01-02 00:00:00"), reading(event_id="a"), reading(event_id=None), reading(event_id=None)]
    a, _ = save(spark, rows, unique=True)
    got = spark.table(a).select(*SENSOR_COLUMNS).collect()
    assert sorted((r.event_id or "", r.timestamp) for r in got) == [("", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:00")]
    empty, _ = save(spark, [])
    assert new_rows(spark, empty, a).count() == 0 and new_rows(spark, a, empty).count() == 2
