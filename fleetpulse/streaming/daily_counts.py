"""K2: streaming daily KPI counts per machine.

Counts add up, so every micro-batch writes the counts of its own rows per
(event date, machine), and the reader sums them. Nothing is kept in memory
between batches, and a row counts however late it comes (rows without a
readable event time count under a NULL date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import COOLANT_LIMIT, NOX_LIMIT
from ..functions.columns import parse_event_time
from ..sources.json_source import bad_record
from .sources import MAX_BYTES_PER_TRIGGER, read_sensor_stream, start_batches
from .versions import BATCH_COL, compact_versions, read_versions, write_batch

DAILY_KEYS = ["event_date", "equipment_id"]
COUNTS = ["total_readings", "total_anomalies", "nox_violations", "overheating_events"]


def daily_counts_plan(readings: DataFrame) -> DataFrame:
    day = F.date_format(parse_event_time("timestamp"), "yyyy-MM-dd").alias("event_date")
    return (readings.groupBy(day, "equipment_id")
            .agg(F.count("event_id").alias("total_readings"),
                 F.count_if(F.col("is_anomaly")).alias("total_anomalies"),
                 F.count_if(F.col("nox_ppm") > NOX_LIMIT).alias("nox_violations"),
                 F.count_if(F.col("temp_coolant_c") > COOLANT_LIMIT).alias("overheating_events")))


def start_daily_counts(spark: SparkSession, source_dir: str, out_path: str, checkpoint_dir: str,
                       available_now: bool = True, max_files_per_trigger: int | None = None,
                       max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER) -> StreamingQuery:
    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(daily_counts_plan(batch.filter(~bad_record(batch))), out_path, batch_id)

    stream = read_sensor_stream(spark, source_dir, max_files_per_trigger, max_bytes_per_trigger)
    return start_batches(stream, run, checkpoint_dir, available_now)


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*DAILY_KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS])


def read_daily_counts(spark: SparkSession, out_path: str) -> DataFrame:
    return _summed(read_versions(spark, out_path).drop(BATCH_COL))


def compact_daily_counts(spark: SparkSession, out_path: str) -> int | None:
    """Fold committed batch folders into one (see ``versions.compact_versions``)."""
    return compact_versions(spark, out_path, _summed)
