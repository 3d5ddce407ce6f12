"""Raw JSON -> bronze table (stamped, partitioned, idempotent append)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import BRONZE_PARTITIONS, PIPELINE_VERSION
from ..functions.columns import ingested_at, pipeline_version, source_file
from ..operators.checks import bronze_summary
from ..operators.dedupe import dedupe_stored
from ..session import scratch_path
from ..sinks import id_index
from ..sinks.writers import (
    INGEST_KEY,
    append_partitioned,
    ingest_key,
    new_rows_only,
    only_keys,
    path_exists,
    rebalanced,
    remove_path,
    stored_keys,
)
from ..sources.drift import store_drift
from ..sources.json_source import read_sensor_json, split_corrupt
from ..sources.layers import BRONZE_SCHEMA, read_layer

#: Default quarantine folder: the bronze folder's name with this suffix.
BESIDE = "_quarantine"
#: So many keys (some hundred bytes each in memory) are broadcast at most.
BROADCAST_KEYS = 1_000_000
QUARANTINE_SCHEMA = "raw_record string, _source_path string"


def stamp_bronze(df: DataFrame, source: Column, version: str = PIPELINE_VERSION) -> DataFrame:
    """Add ingestion metadata; the data columns are not touched.
    ``source`` is the file each row came from (or a fixed label)."""
    return df.withColumns({
        "_ingested_at": ingested_at(),
        "_source_path": source,
        "_pipeline_version": pipeline_version(version),
    })


def first_copies(batch: DataFrame) -> DataFrame:
    """One row per ingest key of a staged batch (keep-first), with the key. Of most rows the key
    is the id; the others, and ids that look like their keys, are compared by the key."""
    keyed = batch.withColumn(INGEST_KEY, ingest_key(batch.columns))
    return dedupe_stored(keyed, INGEST_KEY, F.when(~F.col("event_id").startswith("#"), F.col("event_id")), BROADCAST_KEYS)


def prepare_bronze_batch(spark: SparkSession, batch: DataFrame, bronze_path: str,
                         idempotent: bool = True, fmt: str = "parquet") -> DataFrame:
    """The rows an append would add: batch deduped and minus stored ids. A
    Parquet store has an index of its ids beside it (``sinks.id_index``): first
    it is brought up to the files that it does not cover, those of the last
    append, then only the buckets that may hold an id of the batch are read.
    Other formats are read whole (their id column). The batch should be staged:
    it is read for its keys, for those that repeat, and for the rows."""
    index = bronze_path.rstrip("/") + id_index.BESIDE
    if not idempotent:
        id_index.mark_unique(spark, index, False)
        return batch
    if fmt == "parquet":
        if not id_index.data_files(spark, bronze_path):
            id_index.mark_unique(spark, index, True)

        def read_keys(files: list[str]) -> DataFrame:
            rows = spark.read.schema(BRONZE_SCHEMA).option("basePath", bronze_path).parquet(*files)
            return stored_keys(rows, columns=batch.columns)

        id_index.refresh(spark, bronze_path, index, read_keys)
        if not id_index.segments(spark, index):
            return first_copies(batch).drop(INGEST_KEY)

        def staged(df: DataFrame, name: str) -> DataFrame:
            path = scratch_path(spark, name)
            df.write.parquet(path)
            return spark.read.schema(f"{INGEST_KEY} string").parquet(path)

        keys = staged(batch.select(ingest_key(batch.columns).alias(INGEST_KEY)).distinct(), "batch-keys")
        seen = id_index.seen_keys(spark, keys, index, distinct=True)
        new = staged(keys.join(seen, INGEST_KEY, "left_anti"), "new-keys")
        # Where few of the batch's keys are new, the rows of the others go before any row is
        # sorted or shipped; the keys of many new ones are not broadcast.
        if new.count() <= BROADCAST_KEYS:
            return only_keys(batch, F.broadcast(new))
        return first_copies(batch).join(seen, INGEST_KEY, "left_anti").drop(INGEST_KEY)
    existing = read_layer(spark, bronze_path, BRONZE_SCHEMA, fmt) if path_exists(spark, bronze_path) else None
    return new_rows_only(batch, existing)


def store_quarantine(spark: SparkSession, bad: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append the records that are not in the quarantine yet."""
    bad = bad.distinct()
    if path_exists(spark, path):
        known = spark.read.schema(QUARANTINE_SCHEMA).format(fmt).load(path)
        bad = bad.join(known, ["raw_record", "_source_path"], "left_anti")
    bad.write.mode("append").format(fmt).save(path)


def append_batch(spark: SparkSession, staged: DataFrame, bronze_path: str, quarantine_path: str | None,
                 fmt: str = "parquet", idempotent: bool = True) -> dict:
    """Staged raw records (parsed columns, corrupt text, ``_src``) to bronze and
    quarantine; the step that batch and stream share."""
    good, bad = split_corrupt(staged, F.col("_src"))
    quarantined = bad.count()
    if quarantine_path is not None and quarantined:
        store_quarantine(spark, bad, quarantine_path, fmt)
    good = stamp_bronze(good, F.col("_src")).drop("_src")
    to_add = prepare_bronze_batch(spark, good, bronze_path, idempotent, fmt)
    # distribute by partition directory first, then observe: the metrics node
    # must sit above every exchange
    laid = rebalanced(to_add.select(*BRONZE_SCHEMA.fieldNames()), BRONZE_PARTITIONS)
    obs = Observation("bronze_ingest")
    laid = laid.observe(obs, F.count(F.lit(1)).alias("rows_written"),
                        F.count_if(F.col("event_id").isNull()).alias("null_event_id"))
    append_partitioned(laid, bronze_path, BRONZE_PARTITIONS, fmt, layout=False)
    return dict(obs.get) | {"quarantined": quarantined}


def ingest_to_bronze(spark: SparkSession, source_path: str, bronze_path: str,
                     quarantine_path: str | None = BESIDE, multi_line: bool = False,
                     fmt: str = "parquet", idempotent: bool = True, drift_path: str | None = None) -> dict:
    """Read raw JSON, stamp it and append it to bronze in one write action.

    The JSON is parsed once, into typed columnar staging under the shared
    checkpoint root; the quarantine, the anti join on stored ids and the append
    read that copy. Records that do not parse go to the quarantine, by default
    beside the bronze folder; ``quarantine_path=None`` drops them, and
    ``quarantined`` counts them either way. Re-running the same files appends
    nothing to either (``idempotent``).

    With ``drift_path`` records that have fields beside the declared ones are also kept
    whole there (``sources.drift``), at the price of a second read of the text, and
    ``drifting`` counts the new ones."""
    if quarantine_path == BESIDE:
        quarantine_path = bronze_path.rstrip("/") + BESIDE
    staging = scratch_path(spark, "bronze-staging")
    try:
        raw = read_sensor_json(spark, source_path, multi_line=multi_line).withColumn("_src", source_file())
        raw.write.parquet(staging)
        staged = spark.read.schema(raw.schema).parquet(staging)
        drift = {} if drift_path is None else {"drifting": store_drift(spark, source_path, drift_path)}
        return append_batch(spark, staged, bronze_path, quarantine_path, fmt, idempotent) | drift
    finally:
        remove_path(spark, staging)


def validate_bronze(spark: SparkSession, bronze_path: str, fmt: str = "parquet") -> dict:
    """The five bronze statistics from one aggregate (one row to the driver)."""
    row = bronze_summary(read_layer(spark, bronze_path, BRONZE_SCHEMA, fmt)).first()
    return row.asDict()
