"""Deterministic event de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import METRIC_COLUMNS, SENSOR_COLUMNS
from ..functions.columns import parse_event_time
from ..session import scratch_path

#: So many hashes of repeated keys (eight bytes, some sixty in memory) are broadcast at most.
BROADCAST_HASHES = 1_000_000
_HASH = "_key_hash"


def default_order(df: DataFrame, key: str = "event_id") -> list[Column]:
    """Keep-first order: earliest event time, then the payload columns, so the
    surviving copy does not depend on file or partition order."""
    ts = F.col("timestamp")
    if "timestamp" in df.columns and dict(df.dtypes)["timestamp"] == "string":
        ts = parse_event_time("timestamp")
    order = [ts.asc_nulls_last()] if "timestamp" in df.columns else []
    # payload, then provenance stamps: copies differing only in stamps still
    # resolve the same way on every run
    payload = [c for c in SENSOR_COLUMNS + METRIC_COLUMNS + ["_source_path", "_ingested_at"]
               if c in df.columns and c not in (key, "timestamp")]
    seen: set[str] = set()
    for c in payload:
        if c not in seen:
            seen.add(c)
            order.append(F.col(c).asc_nulls_first())
    if "timestamp" in df.columns:   # one instant may be written with different offsets
        order.append(F.col("timestamp").asc_nulls_first())
    return order


def dedupe_events(df: DataFrame, key: str = "event_id", order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order``. NULL keys are not merged
    (drop or keep them before calling).

    ``row_number() == 1`` is planned with a partial window group limit before
    the shuffle, so each map task ships at most one row per key: a key repeated
    a billion times costs one row per task on the wire, not a hot reducer.
    """
    order = order or default_order(df, key)
    w = Window.partitionBy(key).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def dedupe_stored(df: DataFrame, key: str = "event_id", by: Column | None = None,
                  limit: int = BROADCAST_HASHES) -> DataFrame:
    """``dedupe_events`` for a job over rows that can be read several times (a table, a staged
    batch). First the keys that come more than once are found, by hashes; only their rows are
    sorted and shipped, all others stay where they are. Two keys of one hash cost a sort and
    change nothing. Where more than ``limit`` hashes repeat, all rows are sorted and shipped.

    ``by`` is what is hashed, the key unless told otherwise: an expression that tells rows
    apart as the key does, of fewer columns; rows where it is NULL are sorted and shipped."""
    spark = df.sparkSession
    path = scratch_path(spark, "repeated-keys")
    by = F.col(key) if by is None else by
    hashed = df.withColumn(_HASH, F.when(by.isNotNull(), F.xxhash64(by)).otherwise(F.lit(0).cast("long")))
    hashed.groupBy(_HASH).count().filter(f"count > 1 OR {_HASH} = 0").select(_HASH).write.parquet(path)
    repeated = spark.read.schema(f"{_HASH} long").parquet(path)
    if repeated.count() > limit:
        return dedupe_events(df, key)
    once = hashed.join(F.broadcast(repeated), _HASH, "left_anti").select(*df.columns)
    again = hashed.join(F.broadcast(repeated), _HASH, "left_semi").select(*df.columns)
    return once.unionByName(dedupe_events(again, key))
