"""K1: streaming bronze ingest.

The checkpoint records which files are done. Copies of a record are dropped in two steps.

1. State: the content hashes of the records of the last ``STATE_LIFETIME`` are kept in the state
   store (RocksDB, so state lies on disk), and a copy of one of them goes no
   further. The watermark follows the arrival time, not the event time: a
   reading is never too late for it, however old its event, and a hash leaves the
   state when its lifetime has passed. (A row could only be late if the clock of the
   driver were set back by more than the lifetime.)
2. Exactly: what is left goes through the same steps as a batch ingest: parsed once into
   staging, records that do not parse to the quarantine, one row per id inside the
   batch, no id that is stored (by the index of ids, which reads only the buckets that may
   hold one), append. It catches copies older than the state, and records that
   share an id and differ.

So no row is lost and none is added twice, whatever the state holds: after a restart
with a new checkpoint all files are read again and add nothing. A retried batch
finds what its first attempt stored and adds only the rest. Which of several files
a record is stamped with, if copies come in one micro-batch, is not defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.bronze import BESIDE, append_batch
from ..session import scratch_path
from ..sinks.writers import remove_path
from ..sources.json_source import bad_record
from .sources import MAX_BYTES_PER_TRIGGER, read_sensor_stream, start_batches


STATE_LIFETIME = "1 day"


def drop_recent_copies(stream: DataFrame, lifetime: str) -> DataFrame:
    """Without records whose content came before, within ``lifetime``. Records
    that do not parse are told apart by their file, as in the quarantine."""
    columns = [c for c in stream.columns if c != "_src"]
    content = F.to_json(F.struct(*columns))
    content = F.md5(F.when(bad_record(stream), F.concat_ws("\n", content, "_src")).otherwise(content))
    return (stream.withColumn("_content", content).withColumn("_arrived", F.current_timestamp())
            .withWatermark("_arrived", lifetime).dropDuplicatesWithinWatermark(["_content"]).drop("_content", "_arrived"))


def start_stream_ingest(spark: SparkSession, source_dir: str, bronze_path: str, checkpoint_dir: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER,
                        quarantine_path: str | None = BESIDE,
                        state_lifetime: str | None = STATE_LIFETIME) -> StreamingQuery:
    """``state_lifetime=None`` keeps no state: every copy takes the exact way."""
    if quarantine_path == BESIDE:
        quarantine_path = bronze_path.rstrip("/") + BESIDE

    def run(batch: DataFrame, batch_id: int) -> None:
        staging = scratch_path(spark, "stream-staging")
        try:
            batch.write.parquet(staging)
            staged = spark.read.schema(batch.schema).parquet(staging)
            if not staged.isEmpty():    # a batch may only let state go
                append_batch(spark, staged, bronze_path, quarantine_path)
        finally:
            remove_path(spark, staging)

    stream = read_sensor_stream(spark, source_dir, max_files_per_trigger, max_bytes_per_trigger)
    if state_lifetime is not None:
        stream = drop_recent_copies(stream, state_lifetime)
    return start_batches(stream, run, checkpoint_dir, available_now)
