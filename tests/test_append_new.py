"""What a second ingest of the same readings costs: rows of stored keys are not shipped, and readings are staged once."""

import pytest
from conftest import SMOKE, reading, to_df
from fleetpulse import queries as Q
from fleetpulse.plans import bronze as B
from fleetpulse.session import scratch_path
from pyspark.sql import functions as F


def stamped(spark, rows):
    return B.stamp_bronze(to_df(spark, rows), F.lit("test"))


@pytest.fixture()
def stored(spark):
    path = scratch_path(spark, "bronze")
    first = [reading(event_id=f"E-{k}") for k in range(50)] + [reading(event_id=None, rpm=1.0)]
    B.append_partitioned(B.prepare_bronze_batch(spark, stamped(spark, first), path), path, ["ingestion_date", "equipment_type"])
    again = [*first, reading(event_id="E-7", ingestion_date="2024-02-02"), reading(event_id=None, rpm=2.0),
             reading(event_id=None, rpm=2.0), *[reading(event_id=f"N-{k}", rpm=r) for k in range(9) for r in (900.0, 800.0)]]
    return path, stamped(spark, again)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_an_append_adds_the_first_copy_of_every_new_key(spark, stored, monkeypatch, limit):
    monkeypatch.setattr(B, "BROADCAST_KEYS", limit)
    path, again = stored
    rows = B.prepare_bronze_batch(spark, again, path).select("event_id", "rpm").collect()
    assert sorted(rows, key=str) == sorted([(None, 2.0), *[(f"N-{k}", 800.0) for k in range(9)]], key=str)


def test_few_new_keys_are_broadcast_so_that_no_stored_row_is_shipped(spark, stored, monkeypatch):
    path, again = stored
    plan = lambda: B.prepare_bronze_batch(spark, again, path)._jdf.queryExecution().optimizedPlan().toString()
    few = plan()
    assert "strategy=broadcast" in few and "LeftAnti" not in few
    assert few.index("Window ") < few.index("LeftSemi")     # the join lies below the window
    monkeypatch.setattr(B, "BROADCAST_KEYS", 9)     # ten new keys
    many = plan()
    assert "strategy=broadcast" not in many and "LeftAnti" in many


def test_a_refresh_stages_its_readings_once_and_ingests_all(spark, monkeypatch):
    sensors = Q._bronze(spark, SMOKE)
    sensors = sensors.withColumn("ingestion_date", F.when(Q._number() % 13 == 0, F.lit(None)).otherwise(F.col("ingestion_date")))
    ingested, ingest = [], Q.ingest_to_bronze
    monkeypatch.setattr(Q, "ingest_to_bronze", lambda s, path, *a, **k: ingested.append((path, s.read.json(path).count())) or ingest(s, path, *a, **k))
    silver = Q._refreshed_after(spark, sensors, F.col("ingestion_date") < "2024-01-28", ["2024-01-28", "2024-01-29", "2024-01-30"])
    first = sensors.filter(F.col("ingestion_date") < "2024-01-28").count()
    assert [n for _, n in ingested] == [first, sensors.count()]
    root = ingested[1][0].removesuffix("/*")
    assert spark.read.json(f"{root}/1").count() == sensors.count() - first      # undated readings come then, too
    assert silver.count() > 0
