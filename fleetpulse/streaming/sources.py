"""Streaming reads of raw sensor JSON files, and the micro-batch runner."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..constants import SENSOR_SCHEMA
from ..sources.json_source import CORRUPT

MAX_BYTES_PER_TRIGGER = 10 << 30
#: The state store of queries that keep state: on local disk, with its changes in the checkpoint.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def read_sensor_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
                       max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER) -> DataFrame:
    """Line-delimited JSON files arriving in a folder: the declared columns,
    the text of records that did not parse, and ``_src``, the file of each
    record. The limits bound a micro-batch however large the backlog: by bytes
    unless told otherwise, or by files (Spark takes one of the two)."""
    schema = StructType([*SENSOR_SCHEMA.fields, StructField(CORRUPT, StringType(), True)])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.json(source_dir).withColumn("_src", F.col("_metadata.file_path"))


def start_batches(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint_dir: str,
                  available_now: bool, output_mode: str = "append") -> StreamingQuery:
    """Run a function on every micro-batch. ``run`` must be repeatable: a batch
    is run again after a failure, under the same id.

    Of a stream that keeps state, the session of a micro-batch has adaptive execution off, whatever
    the caller's has: there every exchange keeps its full partition count, and a rebalance before a
    partitioned write does nothing, so that every task writes a file into every folder. ``run`` of
    such a stream stages the batch and works on the staged copy in the caller's session."""
    writer = stream.writeStream.foreachBatch(run).outputMode(output_mode).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    spark = stream.sparkSession
    key, provider = STATE_STORE
    before = spark.conf.get(key)
    spark.conf.set(key, provider)   # a query takes the settings it finds when it starts
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)
