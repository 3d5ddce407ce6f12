from pyspark.sql import functions as F

from conftest import reading, to_df
from fleetpulse.operators.enrich import add_labels
from fleetpulse.operators.kpis import GOLD_MEASURES, daily_kpis, gold_view
from fleetpulse.plans.silver import build_silver


def _gold(spark, rows):
    return daily_kpis(build_silver(to_df(spark, rows), with_lag=False))


def test_hand_computed_group(spark):
    rows = [reading(event_id="1", rpm=1000.0, nox_ppm=360.0, is_anomaly=True, fuel_rate_lh=10.25),
            reading(event_id="2", rpm=1500.0, nox_ppm=410.0, pm25_mg_m3=9.0, fuel_rate_lh=20.5),
            reading(event_id="3", rpm=2000.0, nox_ppm=100.0, temp_coolant_c=106.0, fuel_rate_lh=1.0),
            reading(event_id="4", rpm=500.0, nox_ppm=250.0, pressure_oil_bar=2.0)]
    g = _gold(spark, rows).first()
    assert g.total_readings == 4 and g.total_anomalies == 1 and g.anomaly_rate_pct == 25.0
    assert (g.avg_rpm, g.max_rpm, g.min_rpm) == (1250.0, 2000.0, 500.0)
    assert g.total_fuel_consumed_l == 61.75 and g.avg_fuel_rate_lh == 15.44  # 15.4375 -> HALF_UP
    assert (g.nox_violations, g.pm25_violations, g.overheating_events, g.low_pressure_events) == (2, 1, 1, 1)
    assert (g.critical_emissions, g.high_emissions, g.medium_emissions, g.normal_emissions) == (1, 1, 1, 1)
    # 100 - (2*2/4*100 + 1.5*1/4*100 + 1*1/4*100) = 100 - 162.5 = -62.5 (unclamped)
    assert g.compliance_score == -62.5
    assert g.equipment_health_status == "CRITICAL"
    assert g.engine_issues == 2


def test_all_violating_scores_minus_350(spark):
    rows = [reading(event_id=str(i), nox_ppm=500.0, pm25_mg_m3=20.0, temp_coolant_c=120.0) for i in range(3)]
    assert _gold(spark, rows).first().compliance_score == -350.0


def test_health_bands_on_rounded_rate_and_null_key_group(spark):
    rows = [reading(event_id=f"a{i}", is_anomaly=(i < 1)) for i in range(20)]               # 5.0 -> HEALTHY
    rows += [reading(event_id=f"b{i}", equipment_model=None, is_anomaly=(i < 2)) for i in range(19)]  # 10.53
    got = {r.equipment_model: (r.anomaly_rate_pct, r.equipment_health_status) for r in _gold(spark, rows).collect()}
    assert got == {"M-A": (5.0, "HEALTHY"), None: (10.53, "WARNING")}


def test_no_counted_ids_gives_null_rate_not_error(spark):
    df = to_df(spark, [reading(event_id=None)])
    silver = build_silver(df, with_lag=False).unionByName(
        build_silver(to_df(spark, [reading()]), with_lag=False).withColumn("event_id", F.lit(None).cast("string")))
    g = daily_kpis(silver).first()
    assert g.total_readings == 0 and g.anomaly_rate_pct is None and g.compliance_score is None
    assert g.equipment_health_status == "HEALTHY"


def test_invariants_on_fixture(spark):
    from fleetpulse.sources.fixture import load_sensors
    g = daily_kpis(build_silver(load_sensors(spark, "/root/testdata/sf0.001"), with_lag=False))
    bad = g.filter(
        (F.col("nox_violations") != F.col("critical_emissions") + F.col("high_emissions"))
        | (F.col("critical_emissions") + F.col("high_emissions") + F.col("medium_emissions")
           + F.col("normal_emissions") != F.col("total_readings"))
        | (F.col("min_rpm") > F.col("avg_rpm")) | (F.col("avg_rpm") > F.col("max_rpm")))
    assert bad.count() == 0
    assert gold_view(g).columns[5:5 + len(GOLD_MEASURES)] == GOLD_MEASURES


def test_gold_is_one_partial_hash_aggregate(spark):
    g = _gold(spark, [reading()])
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "SortAggregate" not in plan


def test_odd_values_are_not_left_out_of_sums_and_means(spark):
    """NaN, infinity, huge and very fine values follow the double SUM and AVG."""
    import math

    from fleetpulse.operators.enrich import add_labels
    from fleetpulse.operators.kpis import daily_kpis
    cases = {"huge": [1e13, 2.0], "nan": [float("nan"), 2.0], "inf": [float("inf"), 2.0], "fine": [1.0000004, 1.0000004], "plain": [1.5, 2.5, None]}
    rows = [reading(event_id=f"{k}{i}", ingestion_date=k, fuel_rate_lh=v, rpm=v) for k, vs in cases.items() for i, v in enumerate(vs)]
    got = {r.ingestion_date: r for r in daily_kpis(add_labels(to_df(spark, rows))).collect()}
    assert got["huge"].total_fuel_consumed_l == 1e13 + 2.0 and got["huge"].avg_rpm == 5e12 + 1
    assert math.isnan(got["nan"].total_fuel_consumed_l) and math.isnan(got["nan"].avg_rpm)
    assert math.isinf(got["inf"].total_fuel_consumed_l)
    assert got["fine"].total_fuel_consumed_l == 2.0 and got["plain"].total_fuel_consumed_l == 4.0 and got["plain"].avg_rpm == 2.0


def test_sums_are_exact_and_fall_back_to_doubles(spark):
    """Sums and means of decimals in any order; other values by the double SUM and AVG."""
    from decimal import ROUND_HALF_UP, Decimal
    cases = {"cents": [0.1] * 3 + [0.2, -0.3, None, 999999999.999999], "zero": [-0.0, 0.0], "half": [0.15, 0.15, 0.45, 0.25],
             "large": [1e9, 0.1], "fine": [0.1234567, 1.0], "nan": [float("nan"), 1.0], "inf": [float("inf"), 1.0],
             "many": [999999999.123456, -999999999.123457] * 50, "none": [None]}
    rows = [reading(equipment_id=k, fuel_rate_lh=v) for k, vs in cases.items() for v in vs]
    got = {r.equipment_id: r for r in daily_kpis(add_labels(to_df(spark, rows))).collect()}
    cent = lambda d: float(d.quantize(Decimal("0.01"), ROUND_HALF_UP))
    for k in ("cents", "zero", "half", "many"):
        vs = [Decimal(repr(v)) for v in cases[k] if v is not None]
        assert got[k].total_fuel_consumed_l == cent(sum(vs)), k
        assert got[k].avg_fuel_rate_lh == cent((sum(vs) / len(vs)).quantize(Decimal("1e-10"), ROUND_HALF_UP)), k
    assert (got["large"].total_fuel_consumed_l, got["fine"].avg_fuel_rate_lh) == (1000000000.1, 0.56)
    assert str(got["nan"].avg_fuel_rate_lh) == "nan" and got["inf"].total_fuel_consumed_l == float("inf")
    assert got["none"].total_fuel_consumed_l is None and got["none"].avg_fuel_rate_lh is None
