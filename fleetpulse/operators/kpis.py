"""Gold layer: daily per-machine KPIs, compliance score, health, report.

One ``groupBy(...).agg(...)`` computes every measure of both gold variants.
All aggregation buffers are mutable in place (counts, decimal sums, min/max
of doubles), so Spark plans a partial hash aggregate before the shuffle: a
machine-day that holds a third of all rows is reduced on the map side to one
row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import COOLANT_LIMIT, GROUP_KEYS, NOX_LIMIT, OIL_PRESSURE_LIMIT, PM25_LIMIT
from ..functions.columns import anomaly_rate_pct, compliance_score, health_status

# Gold columns in the SQL model's order (keys first; stamp and scores last).
GOLD_MEASURES = [
    "total_readings", "total_anomalies", "anomaly_rate_pct",
    "avg_rpm", "max_rpm", "min_rpm", "avg_load_pct",
    "avg_temp_coolant_c", "max_temp_coolant_c", "avg_temp_oil_c", "max_temp_oil_c",
    "avg_pressure_oil_bar", "min_pressure_oil_bar",
    "total_fuel_consumed_l", "avg_fuel_rate_lh",
    "avg_nox_ppm", "max_nox_ppm", "avg_pm25_mg_m3", "max_pm25_mg_m3", "avg_co2_pct",
    "nox_violations", "pm25_violations", "overheating_events", "low_pressure_events",
    "critical_emissions", "high_emissions", "medium_emissions", "normal_emissions",
]
GOLD_SCORES = ["compliance_score", "equipment_health_status"]

# The compact variant: fewer measures under the same names, plus engine_issues.
COMPACT_MEASURES = [
    "total_readings", "total_anomalies", "avg_rpm", "max_rpm", "avg_temp_coolant_c",
    "max_temp_coolant_c", "avg_nox_ppm", "max_nox_ppm", "avg_pm25_mg_m3", "total_fuel_consumed_l",
    "nox_violations", "overheating_events", "low_pressure_events", "critical_emissions",
    "engine_issues", "anomaly_rate_pct", "equipment_health_status",
]

REPORT_COLUMNS = [
    "equipment_id", "equipment_type", "equipment_model", "total_readings", "total_anomalies",
    "anomaly_rate_pct", "avg_nox_ppm", "max_nox_ppm", "nox_violations", "overheating_events",
    "equipment_health_status",
]


# The one table of measures: (name, kind, argument, rounding places). The
# DataFrame form, the SQL model and the streaming partial aggregates are all
# rendered from it.
MEASURES: list[tuple[str, str, str, int | None]] = [
    ("total_readings", "count", "COUNT(event_id)", None),
    ("total_anomalies", "count", "COUNT_IF(is_anomaly)", None),
    ("avg_rpm", "avg", "rpm", 1),
    ("max_rpm", "max", "rpm", 1),
    ("min_rpm", "min", "rpm", 1),
    ("avg_load_pct", "avg", "load_pct", 1),
    ("avg_temp_coolant_c", "avg", "temp_coolant_c", 1),
    ("max_temp_coolant_c", "max", "temp_coolant_c", 1),
    ("avg_temp_oil_c", "avg", "temp_oil_c", 1),
    ("max_temp_oil_c", "max", "temp_oil_c", 1),
    ("avg_pressure_oil_bar", "avg", "pressure_oil_bar", 2),
    ("min_pressure_oil_bar", "min", "pressure_oil_bar", 2),
    # Sum of a rate in L/h kept for parity; it is not a volume.
    ("total_fuel_consumed_l", "sum", "fuel_rate_lh", 2),
    ("avg_fuel_rate_lh", "avg", "fuel_rate_lh", 2),
    ("avg_nox_ppm", "avg", "nox_ppm", 1),
    ("max_nox_ppm", "max", "nox_ppm", 1),
    ("avg_pm25_mg_m3", "avg", "pm25_mg_m3", 2),
    ("max_pm25_mg_m3", "max", "pm25_mg_m3", 2),
    ("avg_co2_pct", "avg", "co2_pct", 2),
    ("nox_violations", "count", f"COUNT_IF(nox_ppm > {NOX_LIMIT})", None),
    ("pm25_violations", "count", f"COUNT_IF(pm25_mg_m3 > {PM25_LIMIT})", None),
    ("overheating_events", "count", f"COUNT_IF(temp_coolant_c > {COOLANT_LIMIT})", None),
    ("low_pressure_events", "count", f"COUNT_IF(pressure_oil_bar < {OIL_PRESSURE_LIMIT})", None),
    ("critical_emissions", "count", "COUNT_IF(emissions_severity = 'CRITICAL')", None),
    ("high_emissions", "count", "COUNT_IF(emissions_severity = 'HIGH')", None),
    ("medium_emissions", "count", "COUNT_IF(emissions_severity = 'MEDIUM')", None),
    ("normal_emissions", "count", "COUNT_IF(emissions_severity = 'NORMAL')", None),
]
ENGINE_ISSUES = ("engine_issues", "count", "COUNT_IF(engine_status <> 'NORMAL')", None)

def scaled_sql(column: str) -> str:
    """The metric in millionths, a whole number; NULL for NaN, infinity, and 1e9 or more."""
    return f"CASE WHEN ABS({column}) < 1e9D THEN CAST(RINT({column} * 1e6D) AS BIGINT) END"


def inexact_sql(column: str) -> str:
    """Values that are not a whole number of millionths below 1e9, where a double tells each from
    its neighbours: NaN, infinity, 1e9 or more, more than six decimals."""
    return f"COUNT_IF(NOT ({column} <=> CAST({scaled_sql(column)} AS DOUBLE) / 1e6D))"


def exact_sum_sql(column: str) -> str:
    """The sum of the values of a group without inexact ones, as a decimal. It does not
    depend on row order; the upper and lower bits are added apart, so no sum of longs overflows."""
    high, low = f"SUM(SHIFTRIGHT({scaled_sql(column)}, 24))", f"SUM(({scaled_sql(column)}) & 16777215L)"
    return f"CAST(0.000001BD * (CAST({high} AS DECIMAL(20,0)) * 16777216BD + {low}) AS DECIMAL(28,6))"


def mean_sql(exact_sum: str, n: str) -> str:
    """The mean at the scale that a decimal AVG has (input scale + 4)."""
    return f"CAST(try_divide({exact_sum}, {n}) AS DECIMAL(22,10))"


def measure_sql(kind: str, arg: str, places: int | None) -> str:
    """SQL of one measure. Means and sums are computed exactly, in longs, where every value of the
    group fits; a group with any other value gets the double AVG or SUM, so nothing is left out or cut."""
    if kind == "count":
        return arg
    if kind in ("max", "min"):
        return f"ROUND({kind.upper()}({arg}), {places})"
    exact, double = exact_sum_sql(arg), f"{kind.upper()}({arg})"
    if kind == "avg":
        exact = mean_sql(exact, f"COUNT({arg})")
    return (f"CASE WHEN {inexact_sql(arg)} = 0 THEN CAST(ROUND({exact}, {places}) AS DOUBLE) "
            f"ELSE ROUND({double}, {places}) END")


def _measures(columns: list[str]) -> list:
    items = [*MEASURES, ENGINE_ISSUES] if "engine_status" in columns else MEASURES
    return [F.expr(measure_sql(kind, arg, places)).alias(name) for name, kind, arg, places in items]


def daily_kpis(silver: DataFrame, keys: list[str] | None = None, updated_at: bool = False) -> DataFrame:
    """Every gold measure per (machine, type, model, year, ingestion date),
    NULL keys forming their own group. Returns the SQL model's columns in its
    order, then ``engine_issues`` (the compact variant's extra measure)."""
    keys = keys or GROUP_KEYS
    agg = silver.groupBy(*keys).agg(*_measures(silver.columns))
    agg = agg.withColumn("anomaly_rate_pct", anomaly_rate_pct())
    out = agg.withColumns({
        "compliance_score": compliance_score(),
        "equipment_health_status": health_status("anomaly_rate_pct"),
    })
    cols = keys + GOLD_MEASURES
    if updated_at:
        out = out.withColumn("_updated_at", F.current_timestamp())
        cols = cols + ["_updated_at"]
    cols = cols + GOLD_SCORES + (["engine_issues"] if "engine_issues" in out.columns else [])
    return out.select(*cols)


def gold_view(kpis: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The SQL model's 36 columns (35 without the stamp)."""
    keys = keys or GROUP_KEYS
    stamp = ["_updated_at"] if "_updated_at" in kpis.columns else []
    return kpis.select(*keys, *GOLD_MEASURES, *stamp, *GOLD_SCORES)


#: The compact variant's own names for three measures.
NARROW_NAMES = {"avg_pm25_mg_m3": "avg_pm25", "total_fuel_consumed_l": "total_fuel_lh",
                "equipment_health_status": "equipment_health"}


def narrow_view(kpis: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The compact variant under its own names, with the stamp if there is one."""
    keys = keys or GROUP_KEYS
    stamp = ["_updated_at"] if "_updated_at" in kpis.columns else []
    return kpis.select(*keys, *[F.col(c).alias(NARROW_NAMES.get(c, c)) for c in COMPACT_MEASURES], *stamp)


def compact_view(kpis: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The compact variant: fewer measures plus ``engine_issues``."""
    keys = keys or GROUP_KEYS
    return kpis.select(*keys, *COMPACT_MEASURES)


def equipment_report(kpis: DataFrame) -> DataFrame:
    """Eleven-column fleet report ordered by machine, then day (a global sort
    over the small KPI table; range-partitioned by Spark, no single-task
    collect)."""
    return (kpis.orderBy(F.col("equipment_id").asc_nulls_first(), F.col("ingestion_date").asc_nulls_first())
                .select(*REPORT_COLUMNS))
