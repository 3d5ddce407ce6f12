"""K3: streaming previous-reading deltas, corrected for late readings.

The stored rows lie in partitions by event day, and a table beside them holds the
first and the last reading of every (machine, day). A micro-batch cleans its readings and
drops ids that earlier batches stored (by the id index, which reads only the
buckets that may hold one). An as-of join of its (machine, day) buckets with that table
finds what lies around them: the last reading of the nearest earlier day and
the first of the nearest later one. Only where a new reading is older than the last one
stored of its own machine and day are that day's rows of that machine read.
Everything else follows from the table, however long the history.

These rows go through the range-partitioned batch operator together. New rows are
written, and stored rows whose previous reading changed are written again: outputs are
versions per ``event_id``, readers take the newest. Nothing is kept in
memory between batches, and no reading is too late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import dedupe_events
from ..operators.enrich import add_prev_and_delta, add_time_parts
from ..plans.silver import clean_readings
from ..sinks.writers import remove_path
from ..sources.json_source import CORRUPT, bad_record
from .sources import MAX_BYTES_PER_TRIGGER, read_sensor_stream, start_batches
from .versions import (
    BATCH_COL,
    batch_ids,
    compact_versions,
    newest_per_key,
    published,
    read_versions,
    seen_before,
    write_batch,
)

PREV_COLUMNS = ["event_id", "equipment_id", "timestamp", "rpm", "temp_coolant_c"]
_PREVS = ["rpm_prev", "rpm_delta", "temp_coolant_prev", "temp_coolant_delta"]
DAY = "_day"
#: The day of readings without a readable time: before all others, like NULL times.
NO_DAY = -100_000_000
#: So many batches of boundary rows are folded into one.
FOLD_BOUNDS = 16
OUT_SCHEMA = ", ".join(["event_id string, equipment_id string, timestamp timestamp, rpm double, temp_coolant_c double",
                        *[f"{c} double" for c in _PREVS], f"{DAY} int, {BATCH_COL} long"])


def _at() -> Column:
    """A reading with its place in the machine's order first."""
    return F.struct("timestamp", "event_id", "rpm", "temp_coolant_c")


def with_day(rows: DataFrame) -> DataFrame:
    """``_day``: days since 1970 of the event time, in UTC."""
    return rows.withColumn(DAY, F.coalesce(F.expr("CAST(floor(unix_seconds(timestamp) / 86400) AS INT)"), F.lit(NO_DAY)))


def boundaries(rows: DataFrame) -> DataFrame:
    """The first and the last reading of every (machine, day)."""
    return rows.groupBy("equipment_id", DAY).agg(F.min(_at()).alias("first"), F.max(_at()).alias("last"))


def merge_boundaries(parts: DataFrame) -> DataFrame:
    return parts.groupBy("equipment_id", DAY).agg(F.min("first").alias("first"), F.max("last").alias("last"))


def around(new: DataFrame, bounds: DataFrame) -> DataFrame:
    """For every (machine, day) of the new rows: ``before``, the last stored
    reading of the nearest earlier day; ``after``, the first of the nearest later
    one; ``last`` of the day itself; ``late``, whether a new row comes before that."""
    buckets = new.groupBy("equipment_id", DAY).agg(F.min(_at()).alias("new_first"))
    both = bounds.unionByName(buckets, allowMissingColumns=True).groupBy("equipment_id", DAY).agg(
        *[F.max(c).alias(c) for c in ("first", "last", "new_first")])
    w = Window.partitionBy("equipment_id")
    earlier = w.orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    later = w.orderBy(F.col(DAY).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (both.withColumn("before", F.last("last", ignorenulls=True).over(earlier))
            .withColumn("after", F.last("first", ignorenulls=True).over(later))
            .filter("new_first IS NOT NULL")
            .withColumn("late", F.coalesce(F.col("new_first") < F.col("last"), F.lit(False))).drop("first", "new_first"))


def stored_rows(versions: DataFrame, near: DataFrame) -> DataFrame | None:
    """The stored rows of the late (machine, day) buckets; None if there are none."""
    late = near.filter("late").select(F.col("equipment_id").alias("_k"), F.col(DAY).alias("_d"))
    days = [r[0] for r in late.select("_d").distinct().collect()]       # partitions to read, not rows
    if not days:
        return None
    rows = newest_per_key(versions.filter(F.col(DAY).isin(days)), ["event_id"])
    return rows.join(late, F.col("equipment_id").eqNullSafe(F.col("_k")) & (F.col(DAY) == F.col("_d")), "left_semi")


def clean_batch(batch: DataFrame) -> DataFrame:
    """Passing readings with an id, one per id, time parsed (this batch only)."""
    return add_time_parts(clean_readings(batch)).select(*PREV_COLUMNS)


def process_batch(new: DataFrame, near: DataFrame, stored: DataFrame | None) -> DataFrame:
    """The versions to write: the new rows, and stored rows with another
    previous reading. Rows of role 3 are only there to be the previous one of others."""
    role = lambda df, r: df.withColumn("_role", F.lit(r))
    edge = lambda c, where=F.lit(True): near.filter(where & F.col(c).isNotNull()).select(
        F.col("equipment_id"), f"{c}.timestamp", f"{c}.event_id", f"{c}.rpm", f"{c}.temp_coolant_c").select(*PREV_COLUMNS)
    rows = role(new.select(*PREV_COLUMNS), 0)
    if stored is not None:
        old = stored.select(*PREV_COLUMNS, *[F.col(c).alias(f"_was_{c}") for c in _PREVS])
        rows = rows.unionByName(role(old, 1), allowMissingColumns=True)
    else:
        rows = rows.withColumns({f"_was_{c}": F.lit(None).cast("double") for c in _PREVS})
    for part in (role(edge("after"), 2), role(edge("before"), 3), role(edge("last", ~F.col("late")), 3)):
        rows = rows.unionByName(part, allowMissingColumns=True)
    again = add_prev_and_delta(dedupe_events(rows, order=[F.col("_role").asc()]))
    same = F.lit(True)
    for c in _PREVS:
        same = same & F.col(c).eqNullSafe(F.col(f"_was_{c}"))
    keep = F.col("_role").isin(0, 2) | ((F.col("_role") == 1) & ~same)
    return again.filter(keep).select(*PREV_COLUMNS, *_PREVS)


def start_stream_prev_delta(spark: SparkSession, source_dir: str, out_path: str, state_path: str,
                            checkpoint_dir: str, available_now: bool = True,
                            max_files_per_trigger: int | None = None,
                            max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER) -> StreamingQuery:
    def run(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        # Staged as files: read several times, and every read must see the same rows.
        staging = f"{state_path}/_staging/{BATCH_COL}={batch_id}"

        def staged(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{staging}/{name}")
            return s.read.schema(df.schema).parquet(f"{staging}/{name}")

        try:
            new = staged(with_day(clean_batch(batch.filter(~bad_record(batch)).drop(CORRUPT, "_src"))), "clean")
            new = new.join(seen_before(s, new, out_path, batch_id), "event_id", "left_anti")
            versions = read_versions(s, out_path, before=batch_id, schema=OUT_SCHEMA)
            bounds = read_versions(s, state_path, before=batch_id)
            if versions is None or bounds is None:
                out = add_prev_and_delta(new.select(*PREV_COLUMNS))
            else:
                new = staged(new, "new")
                near = staged(around(new, merge_boundaries(bounds)), "near")
                out = process_batch(new, near, stored_rows(versions, near))
            # both writes replace their folder, so a retry is harmless
            write_batch(boundaries(new), state_path, batch_id)
            out = with_day(out)
            write_batch(out.hint("rebalance", F.col(DAY)).sortWithinPartitions(DAY, "equipment_id", "timestamp"),
                        out_path, batch_id, (DAY,))
        finally:
            remove_path(s, staging)
        if len([i for i in batch_ids(s, state_path) if i > published(s, state_path)[1]]) > FOLD_BOUNDS:
            compact_versions(s, state_path, merge_boundaries)

    stream = read_sensor_stream(spark, source_dir, max_files_per_trigger, max_bytes_per_trigger)
    return start_batches(stream, run, checkpoint_dir, available_now)


def read_prev_delta(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest version of every reading."""
    return newest_per_key(read_versions(spark, out_path, schema=OUT_SCHEMA), ["event_id"]).drop(BATCH_COL, DAY)


def compact_prev_delta(spark: SparkSession, out_path: str) -> int | None:
    """Fold committed batch folders into one (see ``versions.compact_versions``)."""
    return compact_versions(spark, out_path, lambda v: newest_per_key(v, ["event_id"]).drop(BATCH_COL), (DAY,),
                            OUT_SCHEMA)
