"""Bronze -> silver as one lazy DataFrame plan (no actions here).

Order of steps: range rules -> drop NULL ids -> keep-first dedupe -> event
time parts -> previous-reading deltas -> severity and status. De-duplicating
before the lag means a duplicate can never be its own "previous reading".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe_events, dedupe_stored
from ..operators.enrich import add_labels, add_prev_and_delta, add_time_parts
from ..operators.quality import drop_null_key, filter_quality
from ..sinks import id_index
from ..sizing import partitions_for
from . import changes as change_log
from . import edges


def passing_readings(bronze: DataFrame, rules: dict | None = None) -> DataFrame:
    """Rows passing every range rule, with an id."""
    return drop_null_key(filter_quality(bronze, rules))


def clean_readings(bronze: DataFrame, rules: dict | None = None,
                   dedupe: Callable[[DataFrame], DataFrame] = dedupe_events) -> DataFrame:
    """Rows passing every range rule, with an id, one per id."""
    return dedupe(passing_readings(bronze, rules))


def build_silver(bronze: DataFrame, rules: dict | None = None, with_lag: bool = True,
                 strategy: str = "range", num_partitions: int | None = None,
                 transformed_at: bool = False,
                 dedupe: Callable[[DataFrame], DataFrame] = dedupe_events) -> DataFrame:
    """The silver layout: bronze columns (timestamp parsed in place),
    ``_quality_passed``, ``hour_of_day``, ``day_of_week``, previous values and
    deltas (when ``with_lag``), ``emissions_severity``, ``engine_status``."""
    out = add_time_parts(clean_readings(bronze, rules, dedupe))
    if with_lag:
        out = add_prev_and_delta(out, strategy=strategy, num_partitions=num_partitions)
    out = add_labels(out)
    if transformed_at:
        out = out.withColumn("_transformed_at", F.current_timestamp())
    return out


# --- jobs (actions) --------------------------------------------------------

#: What the previous-reading step needs of a silver row, and what it gives.
_LIGHT = ["event_id", "equipment_id", "timestamp", "rpm", "temp_coolant_c", "ingestion_date", "equipment_type"]
_PREVS = ["rpm_prev", "rpm_delta", "temp_coolant_prev", "temp_coolant_delta"]
#: Readings of a range of the previous-reading step, until their number asks for more ranges than
#: ``spark.sql.shuffle.partitions``: a range costs a task with a Python worker, and files of its own.
ROWS_PER_RANGE = 100_000


def _ranges(rows: DataFrame, requested: int | None) -> int:
    """Partitions of the previous-reading step over stored rows."""
    return requested or max(1, min(partitions_for(rows), -(-rows.count() // ROWS_PER_RANGE)))


def _in(values: list[str | None]) -> Column:
    """Whether the ingestion date is one of the values; never NULL."""
    some = F.coalesce(F.col("ingestion_date").isin([d for d in values if d is not None]), F.lit(False))
    return some | F.col("ingestion_date").isNull() if None in values else some


def in_dates(df: DataFrame, values: list[str | None]) -> DataFrame:
    return df.filter(_in(values))


def _only_around(lagged: DataFrame, near: DataFrame) -> DataFrame:
    """Of machines with changed readings, rows from the first changed place to the next row after the
    last one have new previous values; all others keep theirs (what comes
    before them need not have been read)."""
    place = edges.at()
    spans = near.groupBy("_k").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))     # at most two
    rows = lagged.join(spans, F.col("equipment_id").eqNullSafe(F.col("_k")), "left")
    after = (rows.filter("spans IS NOT NULL").select(F.col("_k").alias("_a"), place.alias("place"), F.explode("spans").alias("s"))
             .filter("place > s.hi").groupBy("_a", "s").agg(F.min("place").alias("next"))
             .groupBy("_a").agg(F.collect_list("next").alias("nexts")))
    rows = rows.join(after, F.col("_k").eqNullSafe(F.col("_a")) & F.col("spans").isNotNull(), "left")
    inside = F.exists("spans", lambda s: (place >= s["lo"]) & (place <= s["hi"]))
    next_one = F.exists("nexts", lambda n: place.eqNullSafe(n))
    anew = F.col("_fresh") | F.coalesce(inside, F.lit(False)) | F.coalesce(next_one, F.lit(False))
    return rows.select(*[F.when(anew, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) if c in _PREVS else F.col(c)
                         for c in lagged.columns])


def transform_bronze_to_silver(spark, bronze_path: str, silver_path: str, fmt: str = "parquet",
                               dates: list[str | None] | None = None, strategy: str = "range",
                               num_partitions: int | None = None, changes: bool = False) -> dict:
    """Bronze -> silver in one write action; counts from an Observation.

    ``dates=None`` rebuilds silver (static overwrite). With ``dates`` (ingestion
    dates, None for the NULL date) the result is the same as a rebuild, whatever
    the order in which dates arrive:

    * ids in the refreshed dates, in bronze or in silver, are cleaned again from
      all their bronze copies, so an id stays unique over all dates;
    * rows elsewhere whose previous reading changed are corrected;
    * only the dates that hold such rows are rewritten, and partitions that end
      up without rows are removed.

    What a refresh reads: if every id is known to be in bronze once (it was only
    appended to through the id index), the refreshed dates, and of silver the dates
    that reach into the time of the changed readings of a machine, or come next; what
    lies before them is in the table of edges (``plans.edges``). Otherwise an id may have
    copies under any date: the ids and seven columns of all readings are read.

    ``changes`` begins a log of what refreshes change (``plans.changes``), from which gold
    is kept up to date; a log that exists is always continued.
    """
    from pyspark.sql import Observation

    from ..constants import SILVER_PARTITIONS
    from ..operators.enrich import add_prev_and_delta
    from ..session import scratch_path
    from ..sinks.writers import overwrite_partitioned, path_exists, remove_path
    from ..sources.layers import BRONZE_SCHEMA, SILVER_SCHEMA, read_layer

    bronze = read_layer(spark, bronze_path, BRONZE_SCHEMA, fmt)
    edges_path = silver_path.rstrip("/") + edges.BESIDE
    obs = Observation("silver")
    columns = SILVER_SCHEMA.fieldNames()
    log = silver_path.rstrip("/") + change_log.BESIDE
    number = change_log.begin(spark, log) if changes or path_exists(spark, log) else None
    if dates is None or not path_exists(spark, silver_path):
        silver = build_silver(bronze, strategy=strategy, num_partitions=_ranges(bronze, num_partitions),
                              transformed_at=True, dedupe=dedupe_stored)
        silver = silver.observe(obs, F.count(F.lit(1)).alias("rows_written"))
        edges.invalidate(spark, edges_path)
        if number is not None:
            change_log.record_full(spark, log, number)
        overwrite_partitioned(silver.select(*columns), silver_path, SILVER_PARTITIONS, fmt, dynamic=False)
        if number is not None:
            change_log.complete(spark, log, number)
        return dict(obs.get)

    scratch = scratch_path(spark, "silver-refresh")

    def staged(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    unique = fmt == "parquet" and id_index.is_unique(spark, bronze_path, bronze_path.rstrip("/") + id_index.BESIDE)
    prevs_of = [F.col(c).alias(f"_old_{c}") for c in _PREVS]
    try:
        stored = read_layer(spark, silver_path, SILVER_SCHEMA, fmt)
        if unique:
            known = edges.read(spark, edges_path)
            if known is None:
                known = staged(edges.edges_of(stored), "edges")
            fresh = staged(add_time_parts(clean_readings(in_dates(bronze, dates), dedupe=dedupe_stored)), "fresh")
            old = in_dates(stored, dates)
            changed = fresh.select(*_LIGHT).unionByName(old.select(*_LIGHT))
            others = known.filter(~_in(dates))
            near = staged(edges.surroundings(changed, others), "near")
            # dates to read: partition names, not rows
            read = [r[0] for r in near.select(F.explode("dates").alias("d")).select("d.date").distinct().collect()]
            stored = in_dates(stored, [*dates, *read])
            kept = stored.filter(~_in(dates))
            light = kept.select(*_LIGHT, *prevs_of, F.lit(False).alias("_fresh"))
            ahead = near.filter("before IS NOT NULL").select(
                F.col("_k").alias("equipment_id"), "before.timestamp", "before.event_id", "before.rpm", "before.temp_coolant_c")
            light = (light.unionByName(fresh.select(*_LIGHT, F.lit(True).alias("_fresh")), allowMissingColumns=True)
                     .unionByName(ahead.distinct().join(kept.select("event_id"), "event_id", "left_anti"), allowMissingColumns=True))
            gone = old.select("ingestion_date")
        else:
            ids = staged(in_dates(bronze, dates).select("event_id")
                         .unionByName(in_dates(stored, dates).select("event_id"))
                         .filter("event_id IS NOT NULL").distinct(), "ids")
            fresh = staged(add_time_parts(clean_readings(bronze.join(ids, "event_id", "left_semi"))), "fresh")
            kept = stored.join(ids, "event_id", "left_anti")
            light = kept.select(*_LIGHT, *prevs_of, F.lit(False).alias("_fresh"))
            light = light.unionByName(fresh.select(*_LIGHT, F.lit(True).alias("_fresh")), allowMissingColumns=True)
            gone = stored.join(ids, "event_id", "left_semi").select("ingestion_date")
        lagged = add_prev_and_delta(light, strategy=strategy, num_partitions=_ranges(light, num_partitions))
        if unique:
            lagged = _only_around(lagged.filter("_fresh IS NOT NULL"), near)
        same = F.lit(True)
        for c in _PREVS:
            same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
        lagged = staged(lagged.select("event_id", "ingestion_date", *_PREVS, (F.col("_fresh") | ~same).alias("_changed")),
                        "lagged")
        # the table's partition dates that change: directory names, not rows
        touched = {r[0] for r in lagged.filter("_changed").select("ingestion_date")
                   .unionByName(gone).distinct().collect()}
        touched |= set(dates)
        part = in_dates(kept, list(touched)).drop(*_PREVS)
        new = (add_labels(fresh).withColumn("_transformed_at", F.current_timestamp())
               .unionByName(part, allowMissingColumns=True))
        prevs = in_dates(lagged, list(touched)).select("event_id", *_PREVS)
        silver = staged(new.join(prevs, "event_id").select(*columns), "silver")
        before = {tuple(r) for r in in_dates(stored, list(touched)).select(*SILVER_PARTITIONS).distinct().collect()}
        after = {tuple(r) for r in silver.select(*SILVER_PARTITIONS).distinct().collect()}
        if unique:
            generation = edges.write(spark, edges_path, known.filter(~_in(list(touched))).unionByName(edges.edges_of(silver)))
        if number is not None:
            change_log.record(spark, log, number, in_dates(stored, list(touched)), silver)
        edges.invalidate(spark, edges_path)     # from here on until all is written
        overwrite_partitioned(silver.observe(obs, F.count(F.lit(1)).alias("rows_written")), silver_path,
                              SILVER_PARTITIONS, fmt, dynamic=True)
        for values in before - after:
            remove_path(spark, "/".join([silver_path.rstrip("/"), *map(partition_dir, SILVER_PARTITIONS, values)]))
        if unique:
            edges.publish(spark, edges_path, generation)
        if number is not None:
            change_log.complete(spark, log, number)
        return dict(obs.get)
    finally:
        remove_path(spark, scratch)


def partition_dir(column: str, value: str | None) -> str:
    """The directory name of a partition value, escaped as Spark writes it."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    special = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in special else c for c in value)
