"""K2 by event-time windows: daily counts per machine with bounded state, and a
side table of the rows that came too late.

The counts of a window (a UTC day) are kept in the state store until the watermark, the
greatest event time seen less ``delay``, has passed its end. Update mode: every
micro-batch gives the new totals of the windows it touched, and only those are
written; the reader takes the newest version of a window.

Spark drops a row whose window has been let go, without a word. Here the stream carries
its rows twice: counted by window, and as they are. A window takes all rows of a
micro-batch or none, and every window that took one is in the batch's output,
so the rows whose window is not there are exactly those that were dropped. Their
counts go to the side table (rows without a readable event time too, under a NULL
date). Windows and side table together count every row once, however late it comes:
the same counts as the batch form's.

A retried micro-batch gives the same windows from the same state and replaces what its first
attempt wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import COOLANT_LIMIT, NOX_LIMIT
from ..functions.columns import parse_event_time
from ..session import scratch_path
from ..sinks.writers import remove_path
from ..sources.json_source import bad_record
from .daily_counts import COUNTS, DAILY_KEYS
from .sources import MAX_BYTES_PER_TRIGGER, read_sensor_stream, start_batches
from .versions import BATCH_COL, compact_versions, newest_per_key, read_versions, write_batch

#: How long after the newest reading a day may still get late ones.
DELAY = "2 days"
SCHEMA = "event_date string, equipment_id string, " + ", ".join(f"{c} bigint" for c in COUNTS)


def _utc_day(instant: str) -> Column:
    return F.expr(f"CAST(date_from_unix_date(CAST(FLOOR(unix_micros({instant}) / 86400000000) AS INT)) AS STRING)")


def _marked(readings: DataFrame) -> DataFrame:
    """Per reading its event time, its machine and what it adds to each count."""
    counted = {"total_readings": F.col("event_id").isNotNull(), "total_anomalies": F.col("is_anomaly"),
               "nox_violations": F.col("nox_ppm") > NOX_LIMIT, "overheating_events": F.col("temp_coolant_c") > COOLANT_LIMIT}
    return readings.select(parse_event_time("timestamp").alias("_ts"), "equipment_id",
                           *[F.coalesce(counted[c], F.lit(False)).cast("long").alias(c) for c in COUNTS])


def _sums() -> list:
    return [F.sum(c).alias(c) for c in COUNTS]


def windows_and_rows(readings: DataFrame, delay: str) -> DataFrame:
    """The stream twice: ``_half`` is "window" for the totals of the windows, "row" for the rows."""
    rows = _marked(readings)
    windows = (rows.withWatermark("_ts", delay).groupBy(F.window("_ts", "1 day").alias("w"), "equipment_id").agg(*_sums())
               .select(F.lit("window").alias("_half"), _utc_day("w.start").alias("event_date"), "equipment_id", *COUNTS))
    return windows.unionByName(rows.select(F.lit("row").alias("_half"), _utc_day("_ts").alias("event_date"),
                                           "equipment_id", *COUNTS))


def start_windowed_counts(spark: SparkSession, source_dir: str, out_path: str, checkpoint_dir: str, delay: str = DELAY,
                          available_now: bool = True, max_files_per_trigger: int | None = None,
                          max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER) -> StreamingQuery:
    def run(batch: DataFrame, batch_id: int) -> None:
        staging = scratch_path(spark, "stream-windows")
        try:
            # one action runs the stateful plan; both halves are reduced before the shuffle
            batch.groupBy("_half", *DAILY_KEYS).agg(*_sums()).write.parquet(staging)
            staged = spark.read.schema(f"_half string, {SCHEMA}").parquet(staging)
            if staged.isEmpty():        # a batch may only let state go
                return
            windows, rows = (staged.filter(F.col("_half") == half).drop("_half") for half in ("window", "row"))
            taken = windows.select(*[F.col(c).alias(f"_{c}") for c in DAILY_KEYS])
            late = rows.join(taken, (F.col("event_date") == F.col("_event_date"))       # a NULL date has no window
                             & F.col("equipment_id").eqNullSafe(F.col("_equipment_id")), "left_anti")
            write_batch(windows, f"{out_path}/windows", batch_id)
            write_batch(late, f"{out_path}/late", batch_id)
        finally:
            remove_path(spark, staging)

    stream = read_sensor_stream(spark, source_dir, max_files_per_trigger, max_bytes_per_trigger)
    return start_batches(windows_and_rows(stream.filter(~bad_record(stream)), delay), run, checkpoint_dir,
                         available_now, output_mode="update")


def _newest(versions: DataFrame) -> DataFrame:
    return newest_per_key(versions, DAILY_KEYS)


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*DAILY_KEYS).agg(*_sums())


def _read(spark: SparkSession, path: str, merge) -> DataFrame:
    versions = read_versions(spark, path, schema=f"{SCHEMA}, {BATCH_COL} bigint")
    return spark.createDataFrame([], SCHEMA) if versions is None else merge(versions).select(*DAILY_KEYS, *COUNTS)


def read_windows(spark: SparkSession, out_path: str) -> DataFrame:
    """The totals of every (day, machine) as the windows have them."""
    return _read(spark, f"{out_path}/windows", _newest)


def read_late(spark: SparkSession, out_path: str) -> DataFrame:
    """The side table: counts of the rows that no window took."""
    return _read(spark, f"{out_path}/late", _added)


def read_windowed_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """All rows: windows and side table, and ``late_readings``, the side table's part of ``total_readings``."""
    none = F.lit(0).cast("long")
    both = (read_windows(spark, out_path).withColumn("late_readings", none)
            .unionByName(read_late(spark, out_path).withColumn("late_readings", F.col("total_readings"))))
    return both.groupBy(*DAILY_KEYS).agg(*_sums(), F.sum("late_readings").alias("late_readings"))


def compact_windowed_counts(spark: SparkSession, out_path: str) -> tuple[int | None, int | None]:
    """Fold committed batch folders into one, of both tables (see ``versions.compact_versions``)."""
    return (compact_versions(spark, f"{out_path}/windows", _newest, schema=f"{SCHEMA}, {BATCH_COL} bigint"),
            compact_versions(spark, f"{out_path}/late", _added, schema=f"{SCHEMA}, {BATCH_COL} bigint"))
