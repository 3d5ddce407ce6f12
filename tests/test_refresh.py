"""Refreshes of silver that read only the dates around the changed readings."""

import os
import random

from conftest import reading, to_df
from fleetpulse.plans import edges
from fleetpulse.plans.bronze import append_batch
from fleetpulse.plans.silver import build_silver, transform_bronze_to_silver
from fleetpulse.session import scratch_path
from fleetpulse.sinks import id_index
from fleetpulse.sources.layers import BRONZE_SCHEMA, SILVER_SCHEMA, read_layer
from pyspark.sql import functions as F

STAMPS = {"_ingested_at", "_source_path", "_pipeline_version", "_transformed_at"}


def append(spark, rows, bronze, idempotent=True):
    batch = to_df(spark, rows).withColumn("_corrupt_record", F.lit(None).cast("string")).withColumn("_src", F.lit("f"))
    append_batch(spark, batch, bronze, None, idempotent=idempotent)


def result(df):
    columns = [c for c in SILVER_SCHEMA.fieldNames() if c not in STAMPS]
    return sorted(map(repr, df.select(*columns).collect()))


def full(spark, bronze):
    return result(build_silver(read_layer(spark, bronze, BRONZE_SCHEMA)).withColumn("_transformed_at", F.lit(None)))


def days(rng, day, n=6, late=0, broken=0.05):
    """Readings ingested on one day; ``late`` of them of the days before."""
    at = lambda k: f"2024-01-{day if k >= late else rng.randrange(1, day + 1):02}"
    return [reading(event_id=f"{day}-{k}-{rng.random()}", equipment_id=rng.choice(["EQ-1", "EQ-2", None]),
                    timestamp="broken" if rng.random() < broken else f"{at(k)} {rng.randrange(24):02}:00:{rng.randrange(60):02}",
                    rpm=float(rng.randrange(700, 2000)), ingestion_date=f"2024-01-{day:02}") for k in range(n)]


def spoil(path, day):
    """Files of a date that no reader can read."""
    folder = f"{path.removeprefix('file:')}/ingestion_date=2024-01-{day:02}"
    for top, _, names in os.walk(folder):
        for name in names:
            if name.startswith("."):
                os.remove(f"{top}/{name}")
            elif name.startswith("part-"):
                with open(f"{top}/{name}", "r+b") as f:
                    f.write(b"junk")
                    f.seek(-4, 2)
                    f.write(b"junk")


def test_a_refresh_reads_no_unrelated_date(spark):
    rng = random.Random(7)
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for day in (1, 2, 3, 7, 9):
        append(spark, days(rng, day, n=12, broken=0), bronze)
    transform_bronze_to_silver(spark, bronze, silver)
    append(spark, days(rng, 6, broken=0), bronze)
    transform_bronze_to_silver(spark, bronze, silver, dates=["2024-01-06"])      # edges are built here
    assert edges.read(spark, silver + edges.BESIDE) is not None
    assert result(read_layer(spark, silver, SILVER_SCHEMA)) == full(spark, bronze)
    append(spark, days(rng, 8, broken=0), bronze)
    want = full(spark, bronze)
    first = [r for r in want if "ingestion_date='2024-01-01'" in r]
    spoil(silver, 1)
    spoil(bronze, 2)
    transform_bronze_to_silver(spark, bronze, silver, dates=["2024-01-08"])
    got = result(read_layer(spark, silver, SILVER_SCHEMA).filter("ingestion_date <> '2024-01-01'"))
    assert sorted(got + first) == want


def test_refreshes_with_late_readings_equal_a_full_build(spark):
    """Dates in any order, readings of earlier days among them, the table of edges lost once."""
    rng = random.Random(11)
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    append(spark, days(rng, 5), bronze)
    transform_bronze_to_silver(spark, bronze, silver)
    for k, day in enumerate((8, 3, 6)):
        append(spark, days(rng, day, late=3), bronze)
        if k == 1:
            edges.invalidate(spark, silver + edges.BESIDE)
        transform_bronze_to_silver(spark, bronze, silver, dates=[f"2024-01-{day:02}"])
        assert result(read_layer(spark, silver, SILVER_SCHEMA)) == full(spark, bronze)


def test_copies_of_an_id_take_the_whole_way(spark):
    rng = random.Random(2)
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    index = bronze + id_index.BESIDE
    rows = days(rng, 5)
    append(spark, rows, bronze)
    transform_bronze_to_silver(spark, bronze, silver)
    assert id_index.is_unique(spark, bronze, index)
    append(spark, [{**r, "ingestion_date": "2024-01-02", "timestamp": "2024-01-01 00:00:00"} for r in rows[:2]], bronze, idempotent=False)
    assert not id_index.is_unique(spark, bronze, index)
    transform_bronze_to_silver(spark, bronze, silver, dates=["2024-01-02"])
    assert result(read_layer(spark, silver, SILVER_SCHEMA)) == full(spark, bronze)
