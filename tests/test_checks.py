from conftest import reading, to_df
from fleetpulse.operators.checks import (
    SILVER_CHECKS, Check, bronze_summary, check_accepted_values, check_expression, check_not_null,
    check_unique, run_checks,
)
from fleetpulse.operators.enrich import add_labels


def _df(spark):
    rows = [reading(event_id="a"), reading(event_id="a", nox_ppm=-1.0), reading(event_id=None),
            reading(event_id=None), reading(event_id="b", equipment_id="EQ-999", temp_coolant_c=None),
            reading(event_id="c", equipment_id=None, is_anomaly=True, temp_coolant_c=140.0)]
    return add_labels(to_df(spark, rows))


def test_row_level_checks(spark):
    df = _df(spark)
    assert check_not_null(df, "event_id").count() == 2
    # NULL passes accepted_values and expression tests
    assert [r.event_id for r in check_accepted_values(df, "equipment_id", ["EQ-001"]).collect()] == ["b"]
    assert [r.event_id for r in check_expression(df, "nox_ppm", ">= 0").collect()] == ["a"]
    assert [r.event_id for r in check_expression(df, "temp_coolant_c", "between 50 and 130").collect()] == ["c"]


def test_unique_excludes_null(spark):
    got = [(r.event_id, r.n_records) for r in check_unique(_df(spark), "event_id").collect()]
    assert got == [("a", 2)]


def test_suite_report(spark):
    rep = run_checks(_df(spark))
    got = [(r.check, r.column, r.failing_rows) for r in rep.collect()]
    assert len(got) == len(SILVER_CHECKS) == 12
    assert got[0] == ("not_null", "event_id", 2)
    assert got[1] == ("unique", "event_id", 2)
    assert got[2] == ("not_null", "equipment_id", 1)
    assert got[3] == ("accepted_values", "equipment_id", 1)
    assert got[7] == ("expression_is_true", "nox_ppm", 1)
    assert got[8] == ("not_null", "temp_coolant_c", 1)
    assert got[9] == ("expression_is_true", "temp_coolant_c", 1)


def test_custom_suite(spark):
    rep = run_checks(_df(spark), [Check("accepted_values", "engine_status", ("NORMAL",))])
    assert rep.first().failing_rows == 1


def test_bronze_summary_counts_null_as_distinct_value(spark):
    r = bronze_summary(_df(spark)).first()
    assert (r.total_records, r.null_event_id, r.null_equipment_id, r.distinct_equipment, r.anomaly_records) \
        == (6, 2, 1, 3, 1)
