import math

from pyspark.sql import functions as F

from conftest import reading, to_df
from fleetpulse.constants import QUALITY_RULES
from fleetpulse.operators.quality import (
    chained_range_filters, filter_quality, flag_quality, quality_failure_counts, split_quality,
)


def test_bounds_are_inclusive_and_null_nan_fail(spark):
    rows = [reading(event_id="lo", rpm=0.0), reading(event_id="hi", rpm=3000.0),
            reading(event_id="over", rpm=3000.1), reading(event_id="under", pressure_oil_bar=0.49),
            reading(event_id="null", rpm=None), reading(event_id="nan", rpm=math.nan),
            reading(event_id="plo", pressure_oil_bar=0.5), reading(event_id="phi", co2_pct=20.0)]
    got = {r.event_id: r._quality_passed for r in flag_quality(to_df(spark, rows)).collect()}
    assert got == {"lo": True, "hi": True, "over": False, "under": False, "null": False, "nan": False,
                   "plo": True, "phi": True}


def test_rule_on_absent_column_is_skipped(spark):
    df = to_df(spark, [reading(co2_pct=99.0)]).drop("co2_pct")
    assert filter_quality(df).count() == 1


def test_no_rules_pass_everything(spark):
    df = to_df(spark, [reading(rpm=-5.0)])
    assert flag_quality(df, rules={}).first()._quality_passed is True


def test_split_partitions_rows_and_names_rules(spark):
    rows = [reading(event_id="a"), reading(event_id="b", rpm=5000.0, temp_coolant_c=140.0),
            reading(event_id="c", load_pct=None)]
    passed, failed = split_quality(to_df(spark, rows))
    assert passed.count() + failed.count() == 3
    names = {r.event_id: r.failed_rules for r in failed.collect()}
    assert names == {"b": ["rpm", "temp_coolant_c"], "c": ["load_pct"]}


def test_failure_counts_one_row_per_rule(spark):
    rows = [reading(rpm=5000.0), reading(rpm=6000.0, nox_ppm=-1.0), reading()]
    got = {r.rule: r.failing_rows for r in quality_failure_counts(to_df(spark, rows)).collect()}
    assert got["rpm"] == 2 and got["nox_ppm"] == 1 and got["_any"] == 2
    assert set(got) == set(QUALITY_RULES) | {"_any"}


def test_chained_filters_merge_and_push_down(spark, tmp_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    to_df(spark, [reading(), reading(event_id="x", rpm=9000.0)]).write.parquet(tmp_dir)
    df = chained_range_filters(spark.read.parquet(tmp_dir))
    assert [r.event_id for r in df.collect()] == ["E-1"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rpm,0.0)" in plan and "LessThanOrEqual(pm25_mg_m3,50.0)" in plan
    assert plan.count("Filter (") == 1          # six filters merged into one


def test_filter_pushed_to_scan(spark, tmp_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    to_df(spark, [reading()]).write.parquet(tmp_dir)
    plan = filter_quality(spark.read.parquet(tmp_dir))._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(load_pct,100.0)" in plan
