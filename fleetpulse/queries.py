"""Named queries over a table folder (one per operator family).

Each takes ``(spark, sf_dir)``, reads ``events`` from the folder, derives the
sensor readings and returns a lazy DataFrame over all of them. Timestamps
without an offset are read as UTC; stamps (``current_timestamp``) are left
out so results are deterministic.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import ACCEPTED_EQUIPMENT_IDS, GROUP_KEYS, PIPELINE_VERSION, SENSOR_COLUMNS, SIX_METRIC_QUALITY_RULES
from .functions.columns import anomaly_flag_array
from .operators import checks as C
from .operators.checks import row_count
from .operators.dedupe import dedupe_events as dedupe
from .operators.enrich import add_labels, add_prev_and_delta, add_time_parts
from .operators.envelope import envelope_summary
from .operators.kpis import daily_kpis, narrow_view
from .operators.quality import (
    chained_range_filters,
    drop_null_key,
    filter_quality,
    flag_quality,
    quality_failure_counts,
    split_quality,
    with_failed_rules,
)
from .operators.sketches import ERROR, distinct, store_sketches
from .plans.bronze import ingest_to_bronze
from .plans.gold import build_gold, build_gold_compact, build_report, materialize_gold
from .plans.gold_deltas import update_gold
from .plans.silver import build_silver, clean_readings, transform_bronze_to_silver
from .plans.stored_checks import stored_report, update_checks
from .session import scratch_path
from .sinks.bucketed import new_rows, save_bucketed
from .sinks.writers import INGEST_KEY, overwrite_partitioned, rebalanced, remove_path, save_as_table
from .sinks.zorder import write_zordered
from .sources.drift import field, read_drift
from .sources.fixture import load_sensors, sensors_from_events
from .sources.json_source import read_sensor_json, split_corrupt
from .sources.layers import (
    BRONZE_SCHEMA,
    SILVER_SCHEMA,
    list_tables,
    profile,
    read_layer,
    read_table,
    readings_from_records,
)
from .streaming.daily_counts import read_daily_counts, start_daily_counts
from .streaming.daily_kpis import read_daily_kpis, start_daily_kpis
from .streaming.ingest import start_stream_ingest
from .streaming.prev_delta import read_prev_delta, start_stream_prev_delta
from .streaming.windowed_counts import read_windowed_counts, start_windowed_counts

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_sensors(spark, sf_dir)


def _silver_no_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver without the previous-reading columns: what gold reads (gold
    does not use them, and an opaque Arrow step would not be pruned)."""
    return build_silver(_bronze(spark, sf_dir), with_lag=False)


# --- sources ---------------------------------------------------------------

@query
def sensor_readings(spark, sf_dir):
    """A2/A3: the typed 20-column raw reading layout."""
    return _bronze(spark, sf_dir)


# --- quality ---------------------------------------------------------------

@query
def quality_flags(spark, sf_dir):
    """Every reading with its pass flag and broken rules."""
    df = with_failed_rules(flag_quality(_bronze(spark, sf_dir)))
    return df.select("event_id", "equipment_id", "timestamp", "_quality_passed",
                     F.nullif(F.concat_ws(",", "failed_rules"), F.lit("")).alias("failed_rules"))


@query
def quality_passed(spark, sf_dir):
    """Readings passing all nine rules."""
    return filter_quality(_bronze(spark, sf_dir))


@query
def quality_quarantine(spark, sf_dir):
    """The quarantined side of the split, with the broken rule names."""
    _passed, failed = split_quality(_bronze(spark, sf_dir))
    return failed.select(*SENSOR_COLUMNS, F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def quality_failed_by_rule(spark, sf_dir):
    """Failing rows per rule and overall, one scan."""
    return quality_failure_counts(_bronze(spark, sf_dir))


@query
def quality_six_rules(spark, sf_dir):
    """The six chained range filters, then NULL ids dropped."""
    return drop_null_key(chained_range_filters(_bronze(spark, sf_dir), SIX_METRIC_QUALITY_RULES))


@query
def null_event_ids(spark, sf_dir):
    """Readings without an id."""
    return _bronze(spark, sf_dir).filter(F.col("event_id").isNull())


@query
def anomaly_readings(spark, sf_dir):
    """Readings labelled as anomalies (NULL label excluded)."""
    return _bronze(spark, sf_dir).filter(F.col("is_anomaly"))


# --- silver ----------------------------------------------------------------

@query
def dedupe_events(spark, sf_dir):
    """passing readings with an id, one per id (keep-first)."""
    return clean_readings(_bronze(spark, sf_dir))


@query
def time_parts(spark, sf_dir):
    """Parsed event time, hour of day, day of week (1 = Sunday)."""
    df = add_time_parts(clean_readings(_bronze(spark, sf_dir)))
    return df.select("event_id", "timestamp", "hour_of_day", "day_of_week")


@query
def prev_and_delta(spark, sf_dir):
    """Previous reading of the same machine and the deltas."""
    df = add_prev_and_delta(add_time_parts(clean_readings(_bronze(spark, sf_dir))))
    return df.select("event_id", "equipment_id", "timestamp", "rpm", "rpm_prev", "rpm_delta",
                     "temp_coolant_c", "temp_coolant_prev", "temp_coolant_delta")


@query
def prev_and_delta_range(spark, sf_dir):
    """G1-G3 with the range-partitioned strategy forced (the one chosen for
    inputs above the size threshold), so it is checked at every scale."""
    df = add_prev_and_delta(add_time_parts(clean_readings(_bronze(spark, sf_dir))), strategy="range")
    return df.select("event_id", "equipment_id", "timestamp", "rpm", "rpm_prev", "rpm_delta",
                     "temp_coolant_c", "temp_coolant_prev", "temp_coolant_delta")


@query
def prev_and_delta_range_jvm(spark, sf_dir):
    """G1-G3 with the range strategy's JVM-only form (window per range
    partition instead of the Arrow kernel)."""
    df = add_prev_and_delta(add_time_parts(clean_readings(_bronze(spark, sf_dir))), strategy="range_jvm")
    return df.select("event_id", "equipment_id", "timestamp", "rpm", "rpm_prev", "rpm_delta",
                     "temp_coolant_c", "temp_coolant_prev", "temp_coolant_delta")


@query
def emissions_severity(spark, sf_dir):
    """Severity on every raw reading (NULL NOx is NORMAL)."""
    return add_labels(_bronze(spark, sf_dir)).select("event_id", "nox_ppm", "emissions_severity")


@query
def engine_status(spark, sf_dir):
    """Engine status on every raw reading, first matching rule wins."""
    return add_labels(_bronze(spark, sf_dir)).select(
        "event_id", "temp_coolant_c", "pressure_oil_bar", "rpm", "engine_status")


@query
def anomaly_flags(spark, sf_dir):
    """Threshold codes recomputed from the metrics, text and count."""
    df = _bronze(spark, sf_dir)
    arr = anomaly_flag_array()
    return df.select("event_id", F.nullif(F.array_join(arr, ","), F.lit("")).alias("anomaly_flags"),
                     F.size(arr).alias("n_flags"))


@query
def silver_readings(spark, sf_dir):
    """Whole silver rows (without the transform stamp)."""
    return build_silver(_bronze(spark, sf_dir))


# --- gold ------------------------------------------------------------------

@query
def gold_kpis(spark, sf_dir):
    """The daily KPI table of the SQL model (no stamp)."""
    return build_gold(_silver_no_lag(spark, sf_dir))


@query
def gold_kpis_sql(spark, sf_dir):
    """The same KPI table through Spark SQL over a named silver view."""
    from .plans.gold_sql import gold_kpis_sql as run_sql
    return run_sql(spark, _silver_no_lag(spark, sf_dir), view="silver_sensor_readings")


@query
def gold_kpis_compact(spark, sf_dir):
    """The compact KPI variant, with engine_issues (F32)."""
    return build_gold_compact(_silver_no_lag(spark, sf_dir))


@query
def compliance_score(spark, sf_dir):
    """Weighted violation score with its inputs."""
    k = daily_kpis(_silver_no_lag(spark, sf_dir))
    return k.select(*GROUP_KEYS, "total_readings", "nox_violations", "pm25_violations",
                    "overheating_events", "compliance_score")


@query
def health_status(spark, sf_dir):
    """Anomaly rate and health banding."""
    k = daily_kpis(_silver_no_lag(spark, sf_dir))
    return k.select(*GROUP_KEYS, "total_readings", "total_anomalies", "anomaly_rate_pct",
                    "equipment_health_status")


@query
def equipment_report(spark, sf_dir):
    """H1/H4: eleven-column report ordered by machine."""
    return build_report(_silver_no_lag(spark, sf_dir))


# --- checks and summaries ----------------------------------------------------

@query
def bronze_summary(spark, sf_dir):
    """The five bronze statistics in one aggregate."""
    return C.bronze_summary(_bronze(spark, sf_dir))


@query
def distinct_equipment(spark, sf_dir):
    """I: DISTINCT projection of machine ids."""
    return _bronze(spark, sf_dir).select("equipment_id").distinct()


@query
def distinct_by_sketch(spark, sf_dir):
    """distinct machines and events of every month from stored day
    sketches, held against the exact counts."""
    sensors = _bronze(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    store_sketches(sensors, path)
    month = F.substring("ingestion_date", 1, 7).alias("month")
    days = spark.read.parquet(path)
    days = days.withColumn("ingestion_date", F.col("ingestion_date").cast("string"))
    values = ("equipment_id", "event_id")
    guess = days.groupBy(month).agg(*[distinct(v).alias(f"g_{v}") for v in values])
    exact = sensors.groupBy(month).agg(*[
        (F.count_distinct(v) + F.max(F.col(v).isNull()).cast("long")).alias(f"n_{v}") for v in values])
    both = guess.join(exact.withColumnRenamed("month", "m"), F.col("month").eqNullSafe(F.col("m")))
    near = lambda v: F.abs(F.col(f"g_{v}") - F.col(f"n_{v}")) <= F.greatest(F.lit(ERROR) * F.col(f"n_{v}"), F.lit(0.5))
    return both.select("month", F.col("n_equipment_id").alias("machines"), near("equipment_id").alias("machines_near"),
                       F.col("n_event_id").alias("events"), near("event_id").alias("events_near"))


@query
def layer_row_counts(spark, sf_dir):
    """rows per layer (bronze, silver, gold)."""
    bronze = _bronze(spark, sf_dir)
    groups = build_silver(bronze, with_lag=False).groupBy(*GROUP_KEYS).agg(F.count(F.lit(1)).alias("n"))
    # one pass over silver gives its rows and the gold groups
    both = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("silver"), F.count(F.lit(1)).alias("gold"))
    later = both.select(F.explode(F.array(*[F.struct(F.lit(x).alias("layer"), F.col(x).alias("rows"))
                                            for x in ("silver", "gold")])).alias("r")).select("r.*")
    return C.row_count(bronze).select(F.lit("bronze").alias("layer"), "rows").unionByName(later)


@query
def check_not_null(spark, sf_dir):
    """M1: raw readings failing not_null(event_id)."""
    return C.check_not_null(_bronze(spark, sf_dir), "event_id")


@query
def check_unique(spark, sf_dir):
    """M2: repeated event ids in the raw readings, with their counts."""
    return C.check_unique(_bronze(spark, sf_dir), "event_id")


@query
def check_accepted_values(spark, sf_dir):
    """M3: raw readings whose machine id is not an accepted value."""
    return C.check_accepted_values(_bronze(spark, sf_dir), "equipment_id", ACCEPTED_EQUIPMENT_IDS)


@query
def check_expression(spark, sf_dir):
    """M4: raw readings failing ``temp_coolant_c between 50 and 130``."""
    return C.check_expression(_bronze(spark, sf_dir), "temp_coolant_c", "between 50 and 130")


@query
def data_checks_bronze(spark, sf_dir):
    """M1-M4: the twelve silver tests run on the labelled raw readings."""
    return C.run_checks(add_labels(_bronze(spark, sf_dir)))


@query
def data_checks_tampered(spark, sf_dir):
    """M1-M4: the twelve tests on readings whose labels were tampered with, so
    that every test has failing rows."""
    return C.run_checks(_tampered(add_labels(_bronze(spark, sf_dir))))


@query
def data_checks_silver(spark, sf_dir):
    """M1-M4: the twelve tests on silver (unknown machines and types pass the
    range rules, so their tests fail; the others find nothing)."""
    return C.run_checks(_silver_no_lag(spark, sf_dir))


def _tampered(labelled: DataFrame) -> DataFrame:
    return labelled.withColumns({
        "emissions_severity": F.when(F.col("nox_ppm") > 440, F.lit("EXTREME")).otherwise(F.col("emissions_severity")),
        "engine_status": F.when(F.col("rpm") > 2900, F.lit("RUNAWAY")).otherwise(F.col("engine_status"))})


@query
def data_checks_incremental(spark, sf_dir):
    """M1-M4: the tampered readings again, as a layer that is written in three steps; after
    each the stored checks scan the changed days. Copies of a day's ids come under another
    day and go again."""
    labelled = add_labels(_bronze(spark, sf_dir))
    first, day = _edge_day(labelled, F.min), F.col("ingestion_date")
    copies = labelled.filter(day == _day(first, 3)).withColumn("ingestion_date", F.lit(_day(first, 6)))
    path = scratch_path(spark, "checked")
    steps = [labelled.filter(day < _day(first, 20)).unionByName(copies),
             _tampered(labelled).filter(day < _day(first, 10)),
             _tampered(labelled).filter(day >= _day(first, 10))]
    for rows in steps:
        overwrite_partitioned(rebalanced(rows, ["ingestion_date"]), path, ["ingestion_date"], dynamic=True)
        update_checks(spark, path, schema=labelled.schema)
    return stored_report(spark, path)


# --- sources and sinks on staged files ----------------------------------------
# These write data Spark derives from ``events`` under the shared checkpoint
# root (a new folder per call), run the layer jobs, and read the result back.

def _stage_json(spark, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.mode("overwrite").json(path)
    return path


@query
def bronze_json_scan(spark, sf_dir):
    """A1/A2: readings as line-delimited JSON, read back under the explicit
    schema; records that do not parse would go to quarantine."""
    src = _stage_json(spark, _bronze(spark, sf_dir), "json-src")
    good, _bad = split_corrupt(read_sensor_json(spark, src))
    return good.select(*SENSOR_COLUMNS)


@query
def idempotent_append(spark, sf_dir):
    """One JSON batch ingested twice into a partitioned
    bronze table; the second run appends nothing."""
    src = _stage_json(spark, _bronze(spark, sf_dir), "json-src")
    bronze = scratch_path(spark, "bronze")
    ingest_to_bronze(spark, src, bronze)
    ingest_to_bronze(spark, src, bronze)
    return read_layer(spark, bronze, BRONZE_SCHEMA).select(*SENSOR_COLUMNS)


def _number():
    """The event number of a reading with an id."""
    return F.substring("event_id", 3, 20).cast("long")


@query
def idempotent_append_resent(spark, sf_dir):
    """Some readings have no ingestion date; the file comes twice, and
    then some ids once more under another date. Only the first copies stay."""
    undated = F.when(F.col("event_id").isNotNull() & (_number() % 13 == 0), F.lit(None)).otherwise(F.col("ingestion_date"))
    sensors = _bronze(spark, sf_dir).withColumn("ingestion_date", undated)
    src = _stage_json(spark, sensors, "json-src")
    other = _stage_json(spark, sensors.filter(_number() % 7 == 0).withColumn("ingestion_date", F.lit("2030-01-01")), "json-src")
    bronze = scratch_path(spark, "bronze")
    for path in (src, src, other):
        ingest_to_bronze(spark, path, bronze)
    return read_layer(spark, bronze, BRONZE_SCHEMA).select(*SENSOR_COLUMNS)


@query
def bronze_drift(spark, sf_dir):
    """A1/A2: records with fields that the schema does not declare, ingested
    twice: bronze as ever, the records kept whole and their new fields read back."""
    n = _number()
    extra = [F.when(n % 11 == 0, n % 37).alias("vibration_mm_s"),
             F.when(n % 22 == 0, F.concat(F.lit("v"), (n % 5).cast("string"))).alias("firmware")]
    lines = _bronze(spark, sf_dir).select(F.to_json(F.struct(*SENSOR_COLUMNS, *extra)).alias("value"))
    src, bronze, drift = (scratch_path(spark, p) for p in ("json-drift", "bronze", "bronze-drift"))
    lines.write.text(src)
    for _ in range(2):
        ingest_to_bronze(spark, src, bronze, drift_path=drift)
    kept = read_drift(spark, drift).select(
        "event_id", F.array_join("fields", ",").alias("fields"), field("vibration_mm_s", "long").alias("vibration_mm_s"),
        field("firmware", "string").alias("firmware"), field("equipment_id", "string").alias("equipment_id"))
    ids = read_layer(spark, bronze, BRONZE_SCHEMA).select(F.col("event_id").alias("_id")).filter("_id IS NOT NULL")
    return kept.join(ids, F.col("event_id") == F.col("_id"), "left_semi")


def _with_junk(sensors: DataFrame) -> DataFrame:
    """One JSON line a reading, some replaced by junk by a rule on the event
    number: cut off, of the wrong type, empty, only a bracket."""
    n = _number()
    return sensors.select(
        F.when(n % 101 == 0, F.concat(F.lit('{"event_id": "'), "event_id", F.lit('", ')))
        .when(n % 103 == 0, F.concat(F.lit('{"event_id":"'), "event_id", F.lit('","rpm":"abc"}')))
        .when(n % 107 == 0, F.lit("{}")).when(n % 109 == 0, F.lit("["))
        .otherwise(F.to_json(F.struct(*SENSOR_COLUMNS))).alias("value"))


@query
def bronze_quarantine(spark, sf_dir):
    """A file with junk lines ingested twice; the good rows and the
    quarantined text."""
    src, bronze = scratch_path(spark, "json-junk"), scratch_path(spark, "bronze")
    _with_junk(_bronze(spark, sf_dir)).write.text(src)
    for _ in range(2):
        ingest_to_bronze(spark, src, bronze)
    good = read_layer(spark, bronze, BRONZE_SCHEMA).select(F.lit("good").alias("kind"), "event_id",
                                                           F.lit(None).cast("string").alias("raw_record"))
    bad = spark.read.parquet(f"{bronze}_quarantine").select(
        F.lit("quarantined").alias("kind"), F.lit(None).cast("string").alias("event_id"), "raw_record")
    return good.distinct().unionByName(bad.distinct())


def _edge_day(sensors: DataFrame, edge) -> date:
    return date.fromisoformat(sensors.agg(edge("ingestion_date")).first()[0])


def _day(first: date, offset: int) -> str:
    return (first + timedelta(days=offset)).isoformat()


def _refreshed(spark, steps: list[tuple[DataFrame, list[str] | None]], idempotent: bool = True,
               cumulative: bool = False) -> DataFrame:
    """Bronze ingest and silver refresh per step: (readings, dates to refresh;
    None for a full build). Returns the stored silver. With ``cumulative`` a step's files come
    beside those of the steps before it, and it ingests them all."""
    bronze, silver, root = (scratch_path(spark, p) for p in ("bronze", "silver", "json-steps"))
    for k, (readings, dates) in enumerate(steps):
        readings.write.json(f"{root}/{k}")
        ingest_to_bronze(spark, f"{root}/*" if cumulative else f"{root}/{k}", bronze, idempotent=idempotent)
        transform_bronze_to_silver(spark, bronze, silver, dates=dates)
    return read_layer(spark, silver, SILVER_SCHEMA).select(*_SILVER_OUT)


def _refreshed_after(spark, sensors: DataFrame, first: Column, dates: list[str]) -> DataFrame:
    """A full build from the readings where ``first`` holds; then all readings are ingested and the
    dates refreshed. The first readings are staged once, the second ingest reads their files again."""
    rest = ~F.coalesce(first, F.lit(False))
    return _refreshed(spark, [(sensors.filter(first), None), (sensors.filter(rest), dates)], cumulative=True)


def _ingested_layers(spark, sf_dir):
    """Bronze and silver jobs on staged JSON."""
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    ingest_to_bronze(spark, _stage_json(spark, _bronze(spark, sf_dir), "json-all"), bronze)
    transform_bronze_to_silver(spark, bronze, silver)
    return bronze, silver


_SILVER_OUT = [c for c in SILVER_SCHEMA.fieldNames()
               if c not in ("_ingested_at", "_source_path", "_pipeline_version", "_transformed_at")]


@query
def silver_job(spark, sf_dir):
    """B1/B2/A4: bronze and silver jobs end to end, silver read back by path."""
    _, silver = _ingested_layers(spark, sf_dir)
    return read_layer(spark, silver, SILVER_SCHEMA).select(*_SILVER_OUT)


@query
def incremental_refresh(spark, sf_dir):
    """First dates ingested and transformed, then the last three dates
    appended and refreshed by dynamic partition overwrite; equals a full build."""
    sensors = _bronze(spark, sf_dir)
    last = _edge_day(sensors, F.max)
    new = [_day(last, k) for k in (-2, -1, 0)]
    return _refreshed_after(spark, sensors, F.col("ingestion_date") < new[0], new)


@query
def incremental_gap(spark, sf_dir):
    """Machines idle for more than a week between two refreshes keep their
    previous reading."""
    sensors = _bronze(spark, sf_dir)
    first, last = _edge_day(sensors, F.min), _edge_day(sensors, F.max)
    later = sensors.filter(F.col("ingestion_date") >= _day(first, 9))
    return _refreshed(spark, [(sensors.filter(F.col("ingestion_date") == _day(first, 0)), None),
                              (later, [_day(first, k) for k in range(9, (last - first).days + 1)])])


@query
def incremental_middle_day(spark, sf_dir):
    """A day arrives after the days behind it; their first readings get the
    right previous value."""
    sensors = _bronze(spark, sf_dir)
    middle = _day(_edge_day(sensors, F.min), 10)
    return _refreshed_after(spark, sensors, F.col("ingestion_date") != middle, [middle])


@query
def incremental_split_dates(spark, sf_dir):
    """Two days apart are refreshed at once, with stored days between."""
    sensors = _bronze(spark, sf_dir)
    first = _edge_day(sensors, F.min)
    days = [_day(first, 4), _day(first, 12)]
    return _refreshed_after(spark, sensors, ~F.col("ingestion_date").isin(days), days)


def _moved(sensors: DataFrame, first: date) -> DataFrame:
    """Some readings of the third day, under the sixth and an hour earlier."""
    return sensors.filter((_number() % 7 == 0) & (F.col("ingestion_date") == _day(first, 2))).withColumns({
        "timestamp": (F.to_timestamp("timestamp") - F.expr("INTERVAL 1 HOUR")).cast("string"),
        "ingestion_date": F.lit(_day(first, 5))})


@query
def incremental_resent_id(spark, sf_dir):
    """Ids re-sent under another ingestion date with an earlier event time
    move there and stay unique."""
    sensors = _bronze(spark, sf_dir)
    first = _edge_day(sensors, F.min)
    return _refreshed(spark, [(sensors, None), (_moved(sensors, first), [_day(first, 5)])], idempotent=False)


@query
def catalog_roundtrip(spark, sf_dir):
    """Clean readings saved as a catalog table (twice: the second save
    replaces the first) on the shared root, read back by name."""
    clean, name = clean_readings(_bronze(spark, sf_dir)), f"fleetpulse_clean_{uuid.uuid4().hex[:8]}"
    location = scratch_path(spark, "table")
    for _ in range(2):
        save_as_table(clean, name, location=location)
    return read_table(spark, name)


@query
def catalog_tables(spark, sf_dir):
    """The layers saved as tables of a database of their own, listed, with their rows."""
    clean, database = clean_readings(_bronze(spark, sf_dir)), f"fleetpulse_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    save_as_table(_bronze(spark, sf_dir), f"{database}.bronze")
    save_as_table(clean, f"{database}.silver")
    save_as_table(build_gold(add_labels(add_time_parts(clean))), f"{database}.gold")
    names = [r.tableName for r in list_tables(spark, database).collect()]
    counts = [row_count(read_table(spark, f"{database}.{n}")).select(F.lit(n).alias("table_name"), "rows") for n in names]
    return reduce(DataFrame.unionByName, counts)


@query
def layer_profile(spark, sf_dir):
    """Columns, types and NULLs of the raw readings."""
    return profile(_bronze(spark, sf_dir))


@query
def records_by_client(spark, sf_dir):
    """A3: the twenty readings of the greatest ids, fetched as records by a client, as a
    DataFrame under the declared schema again."""
    last = dedupe(drop_null_key(_bronze(spark, sf_dir))).orderBy(F.desc("event_id")).limit(20)
    return readings_from_records(spark, [r.asDict() for r in last.collect()])


@query
def bucketed_append(spark, sf_dir):
    """All readings against those of the first ten days, both in tables
    bucketed by the ingest key: the unique new ones, without an exchange."""
    sensors, tag = _bronze(spark, sf_dir), uuid.uuid4().hex[:8]
    day = _day(_edge_day(sensors, F.min), 10)
    stored, batch = f"fleetpulse_stored_{tag}", f"fleetpulse_batch_{tag}"
    save_bucketed(sensors.filter(F.col("ingestion_date") < day), stored, unique=True, location=scratch_path(spark, "bucketed"))
    save_bucketed(sensors, batch, location=scratch_path(spark, "bucketed"))
    return new_rows(spark, batch, stored).drop(INGEST_KEY)


@query
def zordered_table(spark, sf_dir):
    """Clean readings in files that are boxes of machine, type and time, read back."""
    clean, staging, path = clean_readings(_bronze(spark, sf_dir)), scratch_path(spark, "clean"), scratch_path(spark, "zorder")
    clean.write.parquet(staging)        # read for the bounds, the range sample and the write
    write_zordered(spark.read.schema(clean.schema).parquet(staging), path, ["equipment_id", "equipment_type", "timestamp"])
    remove_path(spark, staging)
    return read_layer(spark, path, clean.schema)


@query
def layer_stamps(spark, sf_dir):
    """Rows of every layer with each stamp present, and with the
    pipeline's version."""
    bronze, silver = (read_layer(spark, path, schema) for path, schema in
                      zip(_ingested_layers(spark, sf_dir), (BRONZE_SCHEMA, SILVER_SCHEMA)))
    none = F.lit(0).cast("long")
    parts = []
    for name, df in [("bronze", bronze), ("silver", silver), ("gold", build_gold(silver, updated_at=True))]:
        counts = {out: F.count_if(F.col(c).isNotNull()) if c in df.columns else none
                  for out, c in [("ingested", "_ingested_at"), ("sourced", "_source_path"),
                                 ("transformed", "_transformed_at"), ("updated", "_updated_at")]}
        counts["versioned"] = (F.count_if(F.col("_pipeline_version") == PIPELINE_VERSION)
                               if "_pipeline_version" in df.columns else none)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), *[v.alias(k) for k, v in counts.items()])
                     .withColumn("layer", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def silver_narrow(spark, sf_dir):
    """The narrow silver layout: six rules, one row per id, hour and labels."""
    kept = dedupe(drop_null_key(chained_range_filters(_bronze(spark, sf_dir), SIX_METRIC_QUALITY_RULES)))
    return add_labels(add_time_parts(kept).drop("day_of_week"))


@query
def gold_narrow(spark, sf_dir):
    """The compact KPI table under its own names."""
    return narrow_view(daily_kpis(_silver_no_lag(spark, sf_dir)))


@query
def sample_by_id(spark, sf_dir):
    """H2/H3: the first twenty clean readings in the order of their ids."""
    return clean_readings(_bronze(spark, sf_dir)).orderBy("event_id").limit(20)


@query
def gold_table(spark, sf_dir):
    """Gold materialised partitioned by date and clustered by machine,
    then read back (stamp left out)."""
    _, silver = _ingested_layers(spark, sf_dir)
    gold = scratch_path(spark, "gold")
    materialize_gold(spark, silver, gold)
    # declared schema: partition discovery alone would make ingestion_date a date
    schema = build_gold(read_layer(spark, silver, SILVER_SCHEMA), updated_at=True).schema
    return read_layer(spark, gold, schema).drop("_updated_at")


@query
def gold_by_deltas(spark, sf_dir):
    """Gold kept up to date from silver's change log: a day that was not
    there yet, then ids re-sent under another date with an earlier time."""
    sensors = _bronze(spark, sf_dir)
    first = _edge_day(sensors, F.min)
    bronze, silver, gold = (scratch_path(spark, p) for p in ("bronze", "silver", "gold"))
    steps = [(sensors.filter(F.col("ingestion_date") != _day(first, 8)), None),
             (sensors.filter(F.col("ingestion_date") == _day(first, 8)), [_day(first, 8)]),
             (_moved(sensors, first), [_day(first, 5)])]
    for readings, dates in steps:
        ingest_to_bronze(spark, _stage_json(spark, readings, "json-step"), bronze, idempotent=False)
        transform_bronze_to_silver(spark, bronze, silver, dates=dates, changes=True)
        update_gold(spark, silver, gold)
    schema = build_gold(read_layer(spark, silver, SILVER_SCHEMA), updated_at=True).schema
    return read_layer(spark, gold, schema).drop("_updated_at")


@query
def type_envelope_check(spark, sf_dir):
    """Clean readings against their type's normal operating envelope."""
    return envelope_summary(clean_readings(_bronze(spark, sf_dir)))


# --- streaming ---------------------------------------------------------------

def _run(q) -> None:
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


#: Readings of a micro-batch (two gigabytes or so of JSON) at most.
STREAM_FILE_ROWS = 4_000_000
#: Readings from which a micro-batch has one file more, and files of one at most.
ROWS_PER_TASK, TASKS_PER_BATCH = 250_000, 16


def _in_stream_files(rows: DataFrame, n: int, per_batch: int = 1) -> DataFrame:
    """``n`` rows dealt over ``per_batch`` files for every micro-batch that their number asks for,
    however many tasks read them."""
    return rows.repartition(max(1, -(-n // STREAM_FILE_ROWS)) * per_batch)


def _files_per_batch(counts: list[int]) -> int:
    """One file per micro-batch for small stretches, so that one task writes each. Large ones are
    written by several tasks; no stretch may be so small that one of its files gets no row."""
    return max(1, min(TASKS_PER_BATCH, max(counts) // ROWS_PER_TASK, min(counts) // 1000))


def _stage_stream(spark, sf_dir, junk: bool = False) -> str:
    """See ``_stage_batches``."""
    return _stage_batches(spark, sf_dir, junk)[0]


def _stage_batches(spark, sf_dir, junk: bool = False) -> tuple[str, int]:
    """Readings as files in the order of their days: three stretches, and last
    the late readings of the first stretch. Also the number of files that streams read
    a micro-batch: that of every stretch is a multiple of it, so no batch holds two stretches."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    sensors = sensors_from_events(events)
    first, day = _edge_day(sensors, F.min), F.col("ingestion_date")
    early = day < _day(first, 10)
    late = early & F.coalesce(_number() % 17 == 0, F.lit(False))
    root = scratch_path(spark, "json-stream")
    stretches = [early & ~late, ~early & (day < _day(first, 20)), day >= _day(first, 20), late]
    counts = sensors.agg(*[F.count_if(rows).alias(str(k)) for k, rows in enumerate(stretches)]).first()
    per_batch = _files_per_batch(list(counts))
    for k, rows in enumerate(stretches):
        # the events are dealt over the files, and the readings derived by the tasks that write them
        part = sensors_from_events(_in_stream_files(events, counts[k], per_batch)).filter(rows)
        if junk:
            _with_junk(part).write.text(f"{root}/{k}")
        else:
            part.write.json(f"{root}/{k}")
    return f"{root}/*", per_batch


@query
def stream_ingest(spark, sf_dir):
    """K1: streaming bronze ingest run twice over the same files, junk lines
    and late readings among them; the same rows as a batch ingest."""
    src, per_batch = _stage_batches(spark, sf_dir, junk=True)
    out, ckpt = scratch_path(spark, "stream-bronze"), scratch_path(spark, "stream-bronze-ckpt")
    for _ in range(2):
        _run(start_stream_ingest(spark, src, out, ckpt, max_files_per_trigger=per_batch))
    return read_layer(spark, out, BRONZE_SCHEMA).select(*SENSOR_COLUMNS)


@query
def stream_ingest_state(spark, sf_dir):
    """K1: ids re-sent in the next micro-batch, while the state still holds
    them, and three batches later, when it has let them go."""
    src, per_batch = _stage_batches(spark, sf_dir)
    sensors = _bronze(spark, sf_dir)
    first = _edge_day(sensors, F.min)
    again = sensors.filter(F.col("ingestion_date") < _day(first, 10))
    again = _in_stream_files(again, again.count(), per_batch)
    root = src.removesuffix("/*")
    again.write.mode("append").json(f"{root}/1")
    again.write.mode("append").json(f"{root}/3")
    out, ckpt = scratch_path(spark, "stream-bronze"), scratch_path(spark, "stream-bronze-ckpt")
    for _ in range(2):
        _run(start_stream_ingest(spark, src, out, ckpt, max_files_per_trigger=per_batch, state_lifetime="1 second"))
    return read_layer(spark, out, BRONZE_SCHEMA).select(*SENSOR_COLUMNS)


@query
def stream_daily_counts(spark, sf_dir):
    """K2: per-day, per-machine counts from a stream, late rows included."""
    src, per_batch = _stage_batches(spark, sf_dir)
    out, ckpt = scratch_path(spark, "stream-daily"), scratch_path(spark, "stream-daily-ckpt")
    _run(start_daily_counts(spark, src, out, ckpt, max_files_per_trigger=per_batch))
    return read_daily_counts(spark, out)


@query
def stream_windowed_counts(spark, sf_dir):
    """K2: the same counts by event-time windows with a watermark; readings that
    come after their window has closed are counted in the side table."""
    src, per_batch = _stage_batches(spark, sf_dir)
    out, ckpt = scratch_path(spark, "stream-windows"), scratch_path(spark, "stream-windows-ckpt")
    _run(start_windowed_counts(spark, src, out, ckpt, max_files_per_trigger=per_batch))
    return read_windowed_counts(spark, out)


@query
def stream_daily_kpis(spark, sf_dir):
    """Streaming gold: the full daily KPI table from partial aggregates that
    every micro-batch adds, merged by the reader."""
    src, per_batch = _stage_batches(spark, sf_dir)
    out, ckpt = scratch_path(spark, "stream-kpis"), scratch_path(spark, "stream-kpis-ckpt")
    _run(start_daily_kpis(spark, src, out, ckpt, max_files_per_trigger=per_batch))
    return read_daily_kpis(spark, out)


@query
def stream_prev_delta(spark, sf_dir):
    """K3: previous-reading deltas on a stream, corrected for late readings."""
    src, per_batch = _stage_batches(spark, sf_dir)
    out, state = scratch_path(spark, "stream-prev"), scratch_path(spark, "stream-prev-state")
    ckpt = scratch_path(spark, "stream-prev-ckpt")
    _run(start_stream_prev_delta(spark, src, out, state, ckpt, max_files_per_trigger=per_batch))
    return read_prev_delta(spark, out).select(
        "event_id", "equipment_id", "timestamp", "rpm", "rpm_prev", "rpm_delta",
        "temp_coolant_c", "temp_coolant_prev", "temp_coolant_delta")
