"""Streaming gold: daily KPIs maintained from a stream of raw readings.

Every micro-batch cleans its readings, drops ids that earlier batches stored
(first arriving copy kept, an anti join on one column) and writes partial
aggregates per gold key: counts, sums, minima and maxima, all of which merge.
The reader merges them and derives means, rates, compliance and health with the
batch layer's formulas, so the result equals the batch gold table over the same
rows. Nothing is kept in memory between batches, and a row counts however late
it comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import dedupe_stored
from ..operators.partials import kpis_of_partials, merge_partials, partial_kpis
from ..operators.quality import QUALITY_FLAG
from ..plans.silver import clean_readings, passing_readings
from ..session import scratch_path
from ..sinks.writers import remove_path
from ..sources.json_source import CORRUPT, bad_record
from .sources import MAX_BYTES_PER_TRIGGER, read_sensor_stream, start_batches
from .versions import BATCH_COL, compact_versions, read_versions, seen_before, write_batch


def start_daily_kpis(spark: SparkSession, source_dir: str, out_path: str, checkpoint_dir: str,
                     available_now: bool = True, max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER) -> StreamingQuery:
    ids_path = f"{out_path.rstrip('/')}_ids"

    def run(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        staging = scratch_path(s, "stream-kpis")

        def staged(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{staging}/{name}")
            return s.read.schema(df.schema).parquet(f"{staging}/{name}")

        # the passing rows as they come: only those whose id repeats are sorted and shipped
        rows = staged(passing_readings(batch.filter(~bad_record(batch)).drop(CORRUPT, "_src")).drop(QUALITY_FLAG), "rows")
        seen = staged(seen_before(s, rows, ids_path, batch_id), "seen")
        clean = clean_readings(rows, dedupe=dedupe_stored).join(seen, "event_id", "left_anti")
        # the partial aggregates first: ids without them would lose their rows
        write_batch(partial_kpis(clean), out_path, batch_id)
        write_batch(clean.select("event_id"), ids_path, batch_id)
        remove_path(s, staging)

    stream = read_sensor_stream(spark, source_dir, max_files_per_trigger, max_bytes_per_trigger)
    return start_batches(stream, run, checkpoint_dir, available_now)


def read_daily_kpis(spark: SparkSession, out_path: str) -> DataFrame:
    """The gold KPI table (SQL model columns plus ``engine_issues``)."""
    return kpis_of_partials(merge_partials(read_versions(spark, out_path).drop(BATCH_COL)))


def compact_daily_kpis(spark: SparkSession, out_path: str) -> int | None:
    """Fold committed batch folders into one (see ``versions.compact_versions``)."""
    compact_versions(spark, f"{out_path.rstrip('/')}_ids", lambda ids: ids.select("event_id").distinct())
    return compact_versions(spark, out_path, merge_partials)
