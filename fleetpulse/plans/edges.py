"""The first and the last reading of every (machine, ingestion date) of a silver table, kept beside
it, so that a refresh finds what lies before and after the changed readings
without reading the other dates.

The table is written whole as a new generation (it has a row per machine and
date, not per reading) and counts once its marker exists. A refresh removes the marker
before it changes silver and creates the new one afterwards: where there
is none, the table is built from silver again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.writers import path_exists, remove_path

BESIDE = "_edges"
SCHEMA = ("equipment_id string, ingestion_date string, "
          + ", ".join(f"{c} struct<timestamp: timestamp, event_id: string, rpm: double, temp_coolant_c: double>"
                      for c in ("first", "last")))


def at() -> Column:
    """A reading's place in its machine's order, with the values that the next one needs."""
    return F.struct("timestamp", "event_id", "rpm", "temp_coolant_c")


def edges_of(silver: DataFrame) -> DataFrame:
    return silver.groupBy("equipment_id", "ingestion_date").agg(F.min(at()).alias("first"), F.max(at()).alias("last"))


def _generations(spark: SparkSession, path: str) -> list[int]:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_published")
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []
    return sorted(int(m[1]) for m in map(re.compile(r"gen=(\d+)").fullmatch, names) if m)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    found = _generations(spark, path)
    return spark.read.schema(SCHEMA).parquet(f"{path}/gen={found[-1]}") if found else None


def write(spark: SparkSession, path: str, table: DataFrame) -> int:
    """A new generation, not yet in force. What may be left of a crash is replaced."""
    generation = max(_generations(spark, path), default=0) + 1
    staging = scratch_path(spark, "edges")      # the table may be read from the generation it replaces
    table.write.parquet(staging)
    spark.read.schema(SCHEMA).parquet(staging).write.mode("overwrite").parquet(f"{path}/gen={generation}")
    remove_path(spark, staging)
    return generation


def invalidate(spark: SparkSession, path: str) -> None:
    if path_exists(spark, f"{path}/_published"):
        remove_path(spark, f"{path}/_published")


def publish(spark: SparkSession, path: str, generation: int) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_published/gen={generation}")
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jpath):
        raise OSError(f"could not publish {jpath}")
    remove_path(spark, f"{path}/gen={generation - 1}")


def surroundings(changed: DataFrame, others: DataFrame) -> DataFrame:
    """For every machine with changed readings, those with and those without a time
    apart: ``lo`` and ``hi``, their first and last place; ``before``, the last reading of all
    dates that end before lo; ``dates``, the dates that reach into [lo, hi] and the one
    that begins next after hi."""
    span = changed.groupBy(F.col("equipment_id").alias("_k"), F.col("timestamp").isNull().alias("_timeless")).agg(
        F.min(at()).alias("lo"), F.max(at()).alias("hi"))
    joined = span.join(others, F.col("equipment_id").eqNullSafe(F.col("_k")), "left")
    date = F.struct(F.col("ingestion_date").alias("date"))
    some = F.col("first").isNotNull()
    inside = some & (F.col("last") >= F.col("lo")) & (F.col("first") <= F.col("hi"))
    later = some & (F.col("first") > F.col("hi"))
    return joined.groupBy("_k", "_timeless").agg(
        F.any_value("lo").alias("lo"), F.any_value("hi").alias("hi"),
        F.max(F.when(some & (F.col("last") < F.col("lo")), F.col("last"))).alias("before"),
        F.collect_set(F.when(inside, date)).alias("inside"),
        F.min(F.when(later, F.struct("first", date.alias("d")))).alias("next"),
    ).select("_k", "lo", "hi", "before", F.concat("inside", F.when(F.col("next").isNull(), F.array().cast("array<struct<date: string>>"))
                                                  .otherwise(F.array("next.d"))).alias("dates"))
