"""Fields of raw records that the schema does not declare.

The typed scan of ``json_source`` drops them. Here the same files are read as text, and
every record with an undeclared field is kept whole as a VARIANT, with the names of
those fields: nothing a device began to send is lost, and a declared column
can be filled from the kept records later (``field``). Line-delimited JSON only. Records
that are no JSON object belong to the quarantine and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import SENSOR_COLUMNS
from ..sinks.writers import path_exists

SCHEMA = "record_key string, event_id string, fields array<string>, record variant, _source_path string"


def drifting_records(spark: SparkSession, path: str | list[str], declared: list[str] = SENSOR_COLUMNS) -> DataFrame:
    """One row per distinct record with undeclared fields: their sorted names, the
    record as a VARIANT, and the first file it came in."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_source_path"))
    names = F.array_sort(F.array_except(F.json_object_keys("value"), F.array(*map(F.lit, declared))))
    found = lines.withColumn("fields", names).filter(F.size("fields") > 0)
    first = found.groupBy(F.sha2("value", 256).alias("record_key")).agg(
        *[F.any_value(c).alias(c) for c in ("value", "fields")], F.min("_source_path").alias("_source_path"))
    record = F.try_parse_json("value")
    return first.select("record_key", F.try_variant_get(record, "$.event_id", "string").alias("event_id"), "fields",
                        record.alias("record"), "_source_path")


def store_drift(spark: SparkSession, source_path: str | list[str], drift_path: str) -> int:
    """Append the drifting records that are not stored yet; returns how many."""
    new = drifting_records(spark, source_path)
    if path_exists(spark, drift_path):
        new = new.join(read_drift(spark, drift_path).select("record_key"), "record_key", "left_anti")
    obs = Observation("drift")
    new.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(drift_path)
    return obs.get["rows"]


def read_drift(spark: SparkSession, drift_path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(drift_path)


def field(name: str, kind: str) -> Column:
    """An undeclared field of the kept records; NULL where it is missing or of another kind."""
    return F.try_variant_get("record", f"$.{name}", kind)
