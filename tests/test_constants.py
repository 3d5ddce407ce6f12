"""The fixed rules and limits at their bounds."""

from conftest import reading, to_df
from pyspark.sql import functions as F

from fleetpulse.constants import COMPLIANCE_WEIGHTS, QUALITY_RULES
from fleetpulse.functions.columns import compliance_score, health_status
from fleetpulse.operators.quality import filter_quality


def test_rule_bounds_are_inclusive(spark):
    rows, passing = [], set()
    for c, (lo, hi) in QUALITY_RULES.items():
        for name, v in (("lo", lo), ("hi", hi), ("under", lo - 0.001), ("over", hi + 0.001), ("null", None), ("nan", float("nan"))):
            rows.append(reading(event_id=f"{c}-{name}", **{c: None if v is None else float(v)}))
            if name in ("lo", "hi"):
                passing.add(f"{c}-{name}")
    assert {r.event_id for r in filter_quality(to_df(spark, rows)).collect()} == passing


def test_every_violation_has_its_weight(spark):
    for name, weight in COMPLIANCE_WEIGHTS.items():
        counts = {c: 1 if c == name else 0 for c in COMPLIANCE_WEIGHTS}
        df = spark.createDataFrame([(50, *counts.values())], ["total_readings", *counts])
        assert df.select(compliance_score().alias("s")).first().s == 100 - weight * 2


def test_health_bands_are_strict(spark):
    df = spark.createDataFrame([(5.0,), (5.01,), (10.0,), (10.01,), (20.0,), (20.01,), (None,)], "anomaly_rate_pct double")
    got = [r.h for r in df.select(health_status().alias("h")).collect()]
    assert got == ["HEALTHY", "ATTENTION", "ATTENTION", "WARNING", "WARNING", "CRITICAL", "HEALTHY"]
    assert df.select(F.count("*")).first()[0] == 7
