"""Records with undeclared fields are kept whole, once."""

import json

from conftest import reading
from fleetpulse.plans.bronze import ingest_to_bronze
from fleetpulse.session import scratch_path
from fleetpulse.sources.drift import field, read_drift


def write(spark, path, rows):
    spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "value string").coalesce(1).write.text(path)


def test_undeclared_fields(spark):
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    bronze, drift = scratch_path(spark, "bronze"), scratch_path(spark, "drift")
    odd = {**reading(event_id="e2"), "vibration_mm_s": 1.5, "tags": {"x": [1, None]}}
    write(spark, a, [reading(event_id="e1"), odd, odd, {"firmware": "v1"}, "{broken", "[1, 2]", '"text"', ""])
    stats = ingest_to_bronze(spark, a, bronze, drift_path=drift)
    assert stats["rows_written"] == 2 and stats["drifting"] == 2
    assert ingest_to_bronze(spark, a, bronze, drift_path=drift)["drifting"] == 0
    write(spark, b, [odd, {**reading(event_id="e3"), "vibration_mm_s": "high"}])
    assert ingest_to_bronze(spark, b, bronze, drift_path=drift)["drifting"] == 1
    got = {r.event_id: (r.fields, r.v, r.x, r.rpm) for r in read_drift(spark, drift).select(
        "event_id", "fields", field("vibration_mm_s", "double").alias("v"), field("tags.x[0]", "int").alias("x"),
        field("rpm", "double").alias("rpm")).collect()}
    assert got == {"e2": (["tags", "vibration_mm_s"], 1.5, 1, 1000.0), "e3": (["vibration_mm_s"], None, None, 1000.0),
                   None: (["firmware"], None, None, None)}


def test_nothing_undeclared(spark):
    a, drift = scratch_path(spark, "a"), scratch_path(spark, "drift")
    write(spark, a, [reading(event_id="e1")])
    assert ingest_to_bronze(spark, a, scratch_path(spark, "bronze"), drift_path=drift)["drifting"] == 0
    assert read_drift(spark, drift).count() == 0
