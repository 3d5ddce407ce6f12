import random

import pytest
from pyspark.sql import functions as F

from conftest import reading, to_df
from fleetpulse.operators.enrich import add_labels, add_prev_and_delta, add_previous_values, add_time_parts
from fleetpulse.functions.columns import anomaly_flag_array, anomaly_flags


def test_severity_thresholds_strict(spark):
    rows = [reading(event_id=str(v), nox_ppm=v) for v in (200.0, 200.1, 350.0, 350.1, 400.0, 400.1)]
    rows.append(reading(event_id="null", nox_ppm=None))
    got = {r.event_id: r.emissions_severity for r in add_labels(to_df(spark, rows)).collect()}
    assert got == {"200.0": "NORMAL", "200.1": "MEDIUM", "350.0": "MEDIUM", "350.1": "HIGH",
                   "400.0": "HIGH", "400.1": "CRITICAL", "null": "NORMAL"}


def test_engine_status_first_match_wins(spark):
    rows = [reading(event_id="all", temp_coolant_c=106.0, pressure_oil_bar=2.0, rpm=2500.0),
            reading(event_id="oil", pressure_oil_bar=2.49, rpm=2500.0),
            reading(event_id="rpm", rpm=2000.1),
            reading(event_id="edge", temp_coolant_c=105.0, pressure_oil_bar=2.5, rpm=2000.0)]
    got = {r.event_id: r.engine_status for r in add_labels(to_df(spark, rows)).collect()}
    assert got == {"all": "OVERHEATING", "oil": "LOW_OIL_PRESSURE", "rpm": "HIGH_RPM", "edge": "NORMAL"}


def test_anomaly_flags_order_and_null(spark):
    rows = [reading(event_id="none"),
            reading(event_id="all", temp_coolant_c=106.0, temp_oil_c=121.0, pressure_oil_bar=2.4,
                    nox_ppm=351.0, pm25_mg_m3=8.01)]
    df = to_df(spark, rows).select("event_id", anomaly_flags().alias("f"), F.size(anomaly_flag_array()).alias("n"))
    got = {r.event_id: (r.f, r.n) for r in df.collect()}
    assert got["none"] == (None, 0)
    assert got["all"] == ("HIGH_TEMP_COOLANT,HIGH_TEMP_OIL,LOW_PRESSURE_OIL,HIGH_NOX,HIGH_PM25", 5)


def test_time_parts_offsets_and_malformed(spark):
    rows = [reading(event_id="utc", timestamp="2024-01-06T23:30:00+00:00"),     # Saturday
            reading(event_id="brt", timestamp="2024-01-06T23:30:00-03:00"),     # Sunday 02:30 UTC
            reading(event_id="plain", timestamp="2024-01-07 05:00:00"),         # read as UTC
            reading(event_id="bad", timestamp="not a time")]
    got = {r.event_id: (r.hour_of_day, r.day_of_week) for r in add_time_parts(to_df(spark, rows)).collect()}
    assert got == {"utc": (23, 7), "brt": (2, 1), "plain": (5, 1), "bad": (None, None)}


def test_time_parts_do_not_depend_on_session_zone(spark):
    df = to_df(spark, [reading(timestamp="2024-03-10 02:30:00")])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = add_time_parts(df).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.hour_of_day, r.day_of_week) == (2, 1)


def _brute(rows):
    import pandas as pd
    pdf = pd.DataFrame(rows)
    pdf["_t"] = pd.to_datetime(pdf["timestamp"], errors="coerce")
    pdf = pdf.sort_values(["equipment_id", "_t", "event_id"], na_position="first", kind="mergesort")
    pdf["bp"] = pdf.groupby("equipment_id", dropna=False)["rpm"].shift(1)
    return {r.event_id: (None if pd.isna(r.bp) else r.bp) for r in pdf.itertuples()}


@pytest.mark.parametrize("seed,parts,strategy", [(1, 8, "range"), (2, 37, "range"), (3, 1, "range"),
                                                 (4, 64, "range"), (5, 8, "range_jvm"), (6, 37, "range_jvm")])
def test_range_lag_matches_brute_force_with_hot_machine(spark, seed, parts, strategy):
    rnd = random.Random(seed)
    rows = []
    for i in range(3000):
        m = "EQ-HOT" if rnd.random() < 0.6 else f"EQ-{rnd.randint(1, 30):03d}"
        sec = rnd.randint(0, 5000)          # many equal timestamps
        ts = None if rnd.random() < 0.01 else f"2024-01-01 {sec // 3600:02d}:{sec % 3600 // 60:02d}:{sec % 60:02d}"
        rows.append(reading(event_id=f"E{i:05d}", equipment_id=m, timestamp=ts, rpm=float(rnd.randint(0, 3000))))
    df = add_time_parts(to_df(spark, rows).repartition(5))
    out = add_previous_values(df, num_partitions=parts, strategy=strategy)
    got = {r.event_id: r.rpm_prev for r in out.select("event_id", "rpm_prev").collect()}
    assert got == _brute(rows)
    # the plain window agrees
    win = add_previous_values(df, strategy="window")
    assert {r.event_id: r.rpm_prev for r in win.select("event_id", "rpm_prev").collect()} == got


def test_deltas_and_columns(spark):
    rows = [reading(event_id="a", timestamp="2024-01-01 10:00:00", rpm=1000.0, temp_coolant_c=90.0),
            reading(event_id="b", timestamp="2024-01-01 10:00:10", rpm=1200.0, temp_coolant_c=91.5),
            reading(event_id="c", equipment_id="EQ-002", timestamp="2024-01-01 09:00:00", rpm=800.0)]
    out = add_prev_and_delta(add_time_parts(to_df(spark, rows)), strategy="range")
    assert out.columns[-4:] == ["rpm_prev", "rpm_delta", "temp_coolant_prev", "temp_coolant_delta"]
    got = {r.event_id: (r.rpm_prev, r.rpm_delta, r.temp_coolant_delta) for r in out.collect()}
    assert got == {"a": (None, None, None), "b": (1000.0, 200.0, 1.5), "c": (None, None, None)}


def test_range_lag_reuses_one_shuffle(spark):
    rows = [reading(event_id=f"E{i}", timestamp=f"2024-01-01 10:{i // 60:02d}:{i % 60:02d}") for i in range(300)]
    out = add_previous_values(add_time_parts(to_df(spark, rows)), num_partitions=4, strategy="range")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") >= 1
    assert "ReusedExchange" in plan
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan


def test_only_the_key_and_the_metrics_go_to_python(spark):
    plan = add_previous_values(add_time_parts(to_df(spark, [reading()])))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("+- ArrowEvalPython") == 1


def test_default_plan_does_not_depend_on_size(spark, tmp_dir):
    to_df(spark, [reading()]).write.parquet(tmp_dir)
    plan = add_previous_values(add_time_parts(spark.read.parquet(tmp_dir)))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan


def test_range_form_refuses_to_run_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        with pytest.raises(ValueError):
            add_previous_values(add_time_parts(to_df(spark, [reading()])))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_partition_count_is_the_setting_or_the_request(spark):
    from fleetpulse.sizing import partitions_for
    df = to_df(spark, [reading()])
    assert partitions_for(df) == 8 and partitions_for(df, 3) == 3


def test_range_partitions_split_a_hot_machine(spark, tmp_dir):
    """90% of the rows on one machine still spread evenly over the tasks,
    where the plain per-machine window would give one task 90% of them."""
    rnd = random.Random(7)
    rows = [reading(event_id=f"E{i:05d}", equipment_id="EQ-HOT" if rnd.random() < 0.9 else "EQ-002",
                    timestamp=f"2024-01-01 {i // 3600 % 24:02d}:{i // 60 % 60:02d}:{i % 60:02d}")
            for i in range(4000)]
    to_df(spark, rows).write.parquet(tmp_dir)
    df = add_time_parts(spark.read.parquet(tmp_dir))
    ranged = df.repartitionByRange(16, "equipment_id", "timestamp", "event_id")
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) <= 2.5 * (4000 / 16)
    per_machine = [r["count"] for r in df.groupBy("equipment_id").count().collect()]
    assert max(per_machine) > 0.85 * 4000          # what one window task would hold
    out = add_previous_values(df, num_partitions=16, strategy="range")
    assert out.filter(F.col("rpm_prev").isNull()).count() == 2   # one first reading per machine
