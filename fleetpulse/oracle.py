"""Independent DuckDB SQL for every checked query (the correctness oracle).

DuckDB sees the raw test tables only, so each statement first re-derives the
sensor readings from ``events`` (same integer arithmetic as the Spark side),
then computes the query its own way. Rounded means, rates and scores use
exact integer arithmetic with HALF_UP rounding, which is what the Spark
operators produce from exact decimal sums; DuckDB's own ROUND of a double
would differ at ties.
"""

from __future__ import annotations

SENSORS = """
sensors_base AS (
  SELECT event_id AS n, ts, user_id, event_type, CAST(json_extract(props, '$.k') AS INT) AS k FROM events
), sensors_dup AS (
  SELECT * FROM sensors_base UNION ALL SELECT * FROM sensors_base WHERE n % 50 = 0
), sensors_raw AS (
  SELECT
    CASE WHEN n % 997 = 0 THEN NULL ELSE CONCAT('E-', CAST(n AS VARCHAR)) END AS event_id,
    CASE WHEN n % 149 = 0 THEN 'EQ-999' WHEN n % 241 = 0 THEN NULL
      ELSE CONCAT('EQ-00', CAST(user_id % 5 + 1 AS VARCHAR)) END AS equipment_id,
    CASE WHEN n % 173 = 0 THEN 'crane' WHEN n % 181 = 0 THEN NULL ELSE
      CASE user_id % 5 WHEN 0 THEN 'excavator' WHEN 1 THEN 'bulldozer' WHEN 2 THEN 'wheel_loader'
      WHEN 3 THEN 'dump_truck' ELSE 'motor_grader' END END AS equipment_type,
    CASE user_id % 5 WHEN 0 THEN 'M-A' WHEN 1 THEN 'M-B' WHEN 2 THEN 'M-C'
      WHEN 3 THEN 'M-D' ELSE NULL END AS equipment_model,
    CAST(2019 + user_id % 5 AS INTEGER) AS equipment_year,
    CAST(date_trunc('second', ts) AS VARCHAR) AS timestamp,
    CASE WHEN n % 89 = 0 THEN NULL ELSE CAST(5000 + (n * 7919) % 26000 AS DOUBLE) / 10 END AS rpm,
    CASE WHEN n % 229 = 0 THEN NULL ELSE
      CAST(700 + (n * 104729) % 400 + CASE WHEN n % 211 = 0 THEN 300 ELSE 0 END AS DOUBLE) / 10 END AS temp_coolant_c,
    CAST(780 + (n * 1299709) % 500 AS DOUBLE) / 10 AS temp_oil_c,
    CAST(200 + (n * 15485863) % 450 AS DOUBLE) / 100 AS pressure_oil_bar,
    CAST(1000 + (n * 31337) % 5500 AS DOUBLE) / 100 AS fuel_rate_lh,
    CASE WHEN n % 193 = 0 THEN CAST(-1 AS DOUBLE) WHEN n % 227 = 0 THEN NULL
      ELSE CAST(350 + (n * 27644437) % 4200 AS DOUBLE) / 10 END AS nox_ppm,
    CAST(30 + (n * 6700417) % 1170 AS DOUBLE) / 100 AS pm25_mg_m3,
    CAST(300 + (n * 2147483) % 700 AS DOUBLE) / 100 AS co2_pct,
    CAST(k AS DOUBLE) AS load_pct,
    (event_type = 'error' AND k < 50) AS is_anomaly,
    CAST(-23550500 + (n * 3571) % 500000 AS DOUBLE) / 1000000 AS location_lat,
    CAST(-46633300 + (n * 6113) % 500000 AS DOUBLE) / 1000000 AS location_lon,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date
  FROM sensors_dup
), sensors AS (
  SELECT event_id, equipment_id, equipment_type, equipment_model, equipment_year, timestamp,
    rpm, temp_coolant_c, temp_oil_c, pressure_oil_bar, fuel_rate_lh, nox_ppm, pm25_mg_m3,
    co2_pct, load_pct, is_anomaly, location_lat, location_lon,
    NULLIF(CONCAT_WS(',',
      CASE WHEN temp_coolant_c > 105 THEN 'HIGH_TEMP_COOLANT' END,
      CASE WHEN temp_oil_c > 120 THEN 'HIGH_TEMP_OIL' END,
      CASE WHEN pressure_oil_bar < 2.5 THEN 'LOW_PRESSURE_OIL' END,
      CASE WHEN nox_ppm > 350 THEN 'HIGH_NOX' END,
      CASE WHEN pm25_mg_m3 > 8.0 THEN 'HIGH_PM25' END), '') AS anomaly_flags,
    ingestion_date
  FROM sensors_raw
)"""

RULES = [
    ("rpm", "0", "3000"), ("temp_coolant_c", "50", "130"), ("temp_oil_c", "50", "150"),
    ("pressure_oil_bar", "0.5", "10.0"), ("fuel_rate_lh", "0", "100"), ("nox_ppm", "0", "1000"),
    ("pm25_mg_m3", "0", "50"), ("co2_pct", "0", "20"), ("load_pct", "0", "100"),
]
NB_RULES = [r for r in RULES if r[0] in ("rpm", "temp_coolant_c", "temp_oil_c", "pressure_oil_bar",
                                          "nox_ppm", "pm25_mg_m3")]


def _rule(c, lo, hi):
    return f"COALESCE({c} BETWEEN {lo} AND {hi}, FALSE)"


ALL_RULES = " AND ".join(_rule(*r) for r in RULES)
SENSOR_COLS = ("event_id, equipment_id, equipment_type, equipment_model, equipment_year, timestamp, "
               "rpm, temp_coolant_c, temp_oil_c, pressure_oil_bar, fuel_rate_lh, nox_ppm, pm25_mg_m3, "
               "co2_pct, load_pct, is_anomaly, location_lat, location_lon, anomaly_flags, ingestion_date")
PAYLOAD_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in SENSOR_COLS.split(", ")
                          if c not in ("event_id", "timestamp"))

SEVERITY = ("CASE WHEN nox_ppm > 400 THEN 'CRITICAL' WHEN nox_ppm > 350 THEN 'HIGH' "
            "WHEN nox_ppm > 200 THEN 'MEDIUM' ELSE 'NORMAL' END")
STATUS = ("CASE WHEN temp_coolant_c > 105 THEN 'OVERHEATING' WHEN pressure_oil_bar < 2.5 "
          "THEN 'LOW_OIL_PRESSURE' WHEN rpm > 2000 THEN 'HIGH_RPM' ELSE 'NORMAL' END")

CLEAN = f"""
clean AS (
  SELECT {SENSOR_COLS}, TRUE AS _quality_passed FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY CAST(timestamp AS TIMESTAMP) ASC NULLS LAST, {PAYLOAD_ORDER}) AS rn
    FROM sensors WHERE {ALL_RULES} AND event_id IS NOT NULL
  ) WHERE rn = 1
)"""

SILVER = f"""
silver AS (
  SELECT event_id, equipment_id, equipment_type, equipment_model, equipment_year,
    CAST(timestamp AS TIMESTAMP) AS timestamp, rpm, temp_coolant_c, temp_oil_c, pressure_oil_bar,
    fuel_rate_lh, nox_ppm, pm25_mg_m3, co2_pct, load_pct, is_anomaly, location_lat, location_lon,
    anomaly_flags, ingestion_date, _quality_passed,
    CAST(hour(CAST(timestamp AS TIMESTAMP)) AS INTEGER) AS hour_of_day,
    CAST(dayofweek(CAST(timestamp AS TIMESTAMP)) + 1 AS INTEGER) AS day_of_week,
    lag(rpm) OVER w AS rpm_prev,
    rpm - lag(rpm) OVER w AS rpm_delta,
    lag(temp_coolant_c) OVER w AS temp_coolant_prev,
    temp_coolant_c - lag(temp_coolant_c) OVER w AS temp_coolant_delta,
    {SEVERITY} AS emissions_severity,
    {STATUS} AS engine_status
  FROM clean
  WINDOW w AS (PARTITION BY equipment_id ORDER BY CAST(timestamp AS TIMESTAMP) ASC NULLS FIRST,
               event_id ASC NULLS FIRST)
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _avg(col: str, d: int) -> str:
    """HALF_UP mean at d places, exact for metrics with at most 2 decimals."""
    s = f"CAST(SUM(CAST(ROUND({col} * 100) AS BIGINT)) AS BIGINT)"
    n = f"NULLIF(COUNT({col}), 0)"
    return f"CAST(({2 * 10 ** d} * {s} + 100 * {n}) // (200 * {n}) AS DOUBLE) / {10 ** d}"


def _sum2(col: str) -> str:
    return f"CAST(SUM(CAST(ROUND({col} * 100) AS BIGINT)) AS DOUBLE) / 100"


KEYS = "equipment_id, equipment_type, equipment_model, equipment_year, ingestion_date"

KPI = f"""
kpi_raw AS (
  SELECT {KEYS},
    COUNT(event_id) AS total_readings,
    COUNT(CASE WHEN is_anomaly THEN 1 END) AS total_anomalies,
    {_avg('rpm', 1)} AS avg_rpm,
    ROUND(MAX(rpm), 1) AS max_rpm,
    ROUND(MIN(rpm), 1) AS min_rpm,
    {_avg('load_pct', 1)} AS avg_load_pct,
    {_avg('temp_coolant_c', 1)} AS avg_temp_coolant_c,
    ROUND(MAX(temp_coolant_c), 1) AS max_temp_coolant_c,
    {_avg('temp_oil_c', 1)} AS avg_temp_oil_c,
    ROUND(MAX(temp_oil_c), 1) AS max_temp_oil_c,
    {_avg('pressure_oil_bar', 2)} AS avg_pressure_oil_bar,
    ROUND(MIN(pressure_oil_bar), 2) AS min_pressure_oil_bar,
    {_sum2('fuel_rate_lh')} AS total_fuel_consumed_l,
    {_avg('fuel_rate_lh', 2)} AS avg_fuel_rate_lh,
    {_avg('nox_ppm', 1)} AS avg_nox_ppm,
    ROUND(MAX(nox_ppm), 1) AS max_nox_ppm,
    {_avg('pm25_mg_m3', 2)} AS avg_pm25_mg_m3,
    ROUND(MAX(pm25_mg_m3), 2) AS max_pm25_mg_m3,
    {_avg('co2_pct', 2)} AS avg_co2_pct,
    COUNT(CASE WHEN nox_ppm > 350 THEN 1 END) AS nox_violations,
    COUNT(CASE WHEN pm25_mg_m3 > 8.0 THEN 1 END) AS pm25_violations,
    COUNT(CASE WHEN temp_coolant_c > 105 THEN 1 END) AS overheating_events,
    COUNT(CASE WHEN pressure_oil_bar < 2.5 THEN 1 END) AS low_pressure_events,
    COUNT(CASE WHEN emissions_severity = 'CRITICAL' THEN 1 END) AS critical_emissions,
    COUNT(CASE WHEN emissions_severity = 'HIGH' THEN 1 END) AS high_emissions,
    COUNT(CASE WHEN emissions_severity = 'MEDIUM' THEN 1 END) AS medium_emissions,
    COUNT(CASE WHEN emissions_severity = 'NORMAL' THEN 1 END) AS normal_emissions,
    COUNT(CASE WHEN engine_status <> 'NORMAL' THEN 1 END) AS engine_issues
  FROM silver GROUP BY {KEYS}
), kpi_rate AS (
  SELECT *,
    CAST((20000 * total_anomalies + NULLIF(total_readings, 0)) // (2 * NULLIF(total_readings, 0)) AS DOUBLE)
      / 100 AS anomaly_rate_pct,
    (1000 * total_readings - 2000 * nox_violations - 1500 * pm25_violations
      - 1000 * overheating_events) AS _cx
  FROM kpi_raw
), kpi AS (
  SELECT * EXCLUDE (_cx),
    CAST(sign(_cx) * ((2 * abs(_cx) + NULLIF(total_readings, 0)) // (2 * NULLIF(total_readings, 0)))
      AS DOUBLE) / 10 AS compliance_score,
    CASE WHEN anomaly_rate_pct > 20 THEN 'CRITICAL' WHEN anomaly_rate_pct > 10 THEN 'WARNING'
      WHEN anomaly_rate_pct > 5 THEN 'ATTENTION' ELSE 'HEALTHY' END AS equipment_health_status
  FROM kpi_rate
)"""

GOLD_COLS = (f"{KEYS}, total_readings, total_anomalies, anomaly_rate_pct, avg_rpm, max_rpm, min_rpm, "
             "avg_load_pct, avg_temp_coolant_c, max_temp_coolant_c, avg_temp_oil_c, max_temp_oil_c, "
             "avg_pressure_oil_bar, min_pressure_oil_bar, total_fuel_consumed_l, avg_fuel_rate_lh, "
             "avg_nox_ppm, max_nox_ppm, avg_pm25_mg_m3, max_pm25_mg_m3, avg_co2_pct, nox_violations, "
             "pm25_violations, overheating_events, low_pressure_events, critical_emissions, high_emissions, "
             "medium_emissions, normal_emissions, compliance_score, equipment_health_status")
COMPACT_COLS = (f"{KEYS}, total_readings, total_anomalies, avg_rpm, max_rpm, avg_temp_coolant_c, "
                "max_temp_coolant_c, avg_nox_ppm, max_nox_ppm, avg_pm25_mg_m3, total_fuel_consumed_l, "
                "nox_violations, overheating_events, low_pressure_events, critical_emissions, engine_issues, "
                "anomaly_rate_pct, equipment_health_status")

LABELLED = f"""
labelled AS (SELECT *, {SEVERITY} AS emissions_severity, {STATUS} AS engine_status FROM sensors)"""

CHECKS = [
    ("not_null", "event_id", "event_id IS NULL"),
    ("unique", "event_id", None),
    ("not_null", "equipment_id", "equipment_id IS NULL"),
    ("accepted_values", "equipment_id",
     "equipment_id NOT IN ('EQ-001', 'EQ-002', 'EQ-003', 'EQ-004', 'EQ-005')"),
    ("not_null", "equipment_type", "equipment_type IS NULL"),
    ("accepted_values", "equipment_type",
     "equipment_type NOT IN ('excavator', 'bulldozer', 'wheel_loader', 'dump_truck', 'motor_grader')"),
    ("not_null", "nox_ppm", "nox_ppm IS NULL"),
    ("expression_is_true", "nox_ppm", "NOT (nox_ppm >= 0)"),
    ("not_null", "temp_coolant_c", "temp_coolant_c IS NULL"),
    ("expression_is_true", "temp_coolant_c", "NOT (temp_coolant_c BETWEEN 50 AND 130)"),
    ("accepted_values", "emissions_severity",
     "emissions_severity NOT IN ('NORMAL', 'MEDIUM', 'HIGH', 'CRITICAL')"),
    ("accepted_values", "engine_status",
     "engine_status NOT IN ('NORMAL', 'OVERHEATING', 'LOW_OIL_PRESSURE', 'HIGH_RPM')"),
]


def _checks_report(table: str) -> str:
    parts = []
    for kind, col, cond in CHECKS:
        if kind == "unique":
            parts.append(
                f"SELECT '{kind}' AS \"check\", '{col}' AS \"column\", CAST(COALESCE(SUM(c), 0) AS BIGINT) "
                f"AS failing_rows FROM (SELECT COUNT(*) AS c FROM {table} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING COUNT(*) > 1)")
        else:
            parts.append(f"SELECT '{kind}' AS \"check\", '{col}' AS \"column\", "
                         f"COUNT(CASE WHEN {cond} THEN 1 END) AS failing_rows FROM {table}")
    return "\nUNION ALL ".join(parts)


def _failed_rules_text() -> str:
    items = ", ".join(f"CASE WHEN NOT {_rule(c, lo, hi)} THEN '{c}' END" for c, lo, hi in RULES)
    return f"NULLIF(CONCAT_WS(',', {items}), '')"


def _flag_count() -> str:
    return ("CAST((CASE WHEN temp_coolant_c > 105 THEN 1 ELSE 0 END) + (CASE WHEN temp_oil_c > 120 THEN 1 ELSE 0 END)"
            " + (CASE WHEN pressure_oil_bar < 2.5 THEN 1 ELSE 0 END) + (CASE WHEN nox_ppm > 350 THEN 1 ELSE 0 END)"
            " + (CASE WHEN pm25_mg_m3 > 8.0 THEN 1 ELSE 0 END) AS INTEGER)")


ORACLE_SQL: dict[str, str] = {
    "sensor_readings": _with(SENSORS) + "SELECT * FROM sensors",
    "quality_flags": _with(SENSORS) + (
        f"SELECT event_id, equipment_id, timestamp, ({ALL_RULES}) AS _quality_passed, "
        f"{_failed_rules_text()} AS failed_rules FROM sensors"),
    "quality_passed": _with(SENSORS) + f"SELECT *, TRUE AS _quality_passed FROM sensors WHERE {ALL_RULES}",
    "quality_quarantine": _with(SENSORS) + (
        f"SELECT *, {_failed_rules_text()} AS failed_rules FROM sensors WHERE NOT ({ALL_RULES})"),
    "quality_failed_by_rule": _with(SENSORS) + "\nUNION ALL ".join(
        [f"SELECT '{c}' AS rule, COUNT(CASE WHEN NOT {_rule(c, lo, hi)} THEN 1 END) AS failing_rows FROM sensors"
         for c, lo, hi in RULES]
        + [f"SELECT '_any' AS rule, COUNT(CASE WHEN NOT ({ALL_RULES}) THEN 1 END) AS failing_rows FROM sensors"]),
    "quality_six_rules": _with(SENSORS) + (
        "SELECT * FROM sensors WHERE " + " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, lo, hi in NB_RULES)
        + " AND event_id IS NOT NULL"),
    "null_event_ids": _with(SENSORS) + "SELECT * FROM sensors WHERE event_id IS NULL",
    "anomaly_readings": _with(SENSORS) + "SELECT * FROM sensors WHERE is_anomaly",
    "dedupe_events": _with(SENSORS, CLEAN) + "SELECT * FROM clean",
    "time_parts": _with(SENSORS, CLEAN, SILVER) + "SELECT event_id, timestamp, hour_of_day, day_of_week FROM silver",
    "prev_and_delta": _with(SENSORS, CLEAN, SILVER) + (
        "SELECT event_id, equipment_id, timestamp, rpm, rpm_prev, rpm_delta, temp_coolant_c, "
        "temp_coolant_prev, temp_coolant_delta FROM silver"),
    "prev_and_delta_range": _with(SENSORS, CLEAN, SILVER) + (
        "SELECT event_id, equipment_id, timestamp, rpm, rpm_prev, rpm_delta, temp_coolant_c, "
        "temp_coolant_prev, temp_coolant_delta FROM silver"),
    "prev_and_delta_range_jvm": _with(SENSORS, CLEAN, SILVER) + (
        "SELECT event_id, equipment_id, timestamp, rpm, rpm_prev, rpm_delta, temp_coolant_c, "
        "temp_coolant_prev, temp_coolant_delta FROM silver"),
    "emissions_severity": _with(SENSORS) + f"SELECT event_id, nox_ppm, {SEVERITY} AS emissions_severity FROM sensors",
    "engine_status": _with(SENSORS) + (
        f"SELECT event_id, temp_coolant_c, pressure_oil_bar, rpm, {STATUS} AS engine_status FROM sensors"),
    "anomaly_flags": _with(SENSORS) + f"SELECT event_id, anomaly_flags, {_flag_count()} AS n_flags FROM sensors",
    "silver_readings": _with(SENSORS, CLEAN, SILVER) + "SELECT * FROM silver",
    "gold_kpis": _with(SENSORS, CLEAN, SILVER, KPI) + f"SELECT {GOLD_COLS} FROM kpi",
    "gold_kpis_sql": _with(SENSORS, CLEAN, SILVER, KPI) + f"SELECT {GOLD_COLS} FROM kpi",
    "gold_kpis_compact": _with(SENSORS, CLEAN, SILVER, KPI) + f"SELECT {COMPACT_COLS} FROM kpi",
    "compliance_score": _with(SENSORS, CLEAN, SILVER, KPI) + (
        f"SELECT {KEYS}, total_readings, nox_violations, pm25_violations, overheating_events, "
        "compliance_score FROM kpi"),
    "health_status": _with(SENSORS, CLEAN, SILVER, KPI) + (
        f"SELECT {KEYS}, total_readings, total_anomalies, anomaly_rate_pct, equipment_health_status FROM kpi"),
    "equipment_report": _with(SENSORS, CLEAN, SILVER, KPI) + (
        "SELECT equipment_id, equipment_type, equipment_model, total_readings, total_anomalies, "
        "anomaly_rate_pct, avg_nox_ppm, max_nox_ppm, nox_violations, overheating_events, "
        "equipment_health_status FROM kpi ORDER BY equipment_id NULLS FIRST"),
    "bronze_summary": _with(SENSORS) + (
        "SELECT COUNT(*) AS total_records, COUNT(CASE WHEN event_id IS NULL THEN 1 END) AS null_event_id, "
        "COUNT(CASE WHEN equipment_id IS NULL THEN 1 END) AS null_equipment_id, "
        "(SELECT COUNT(*) FROM (SELECT DISTINCT equipment_id FROM sensors)) AS distinct_equipment, "
        "COUNT(CASE WHEN is_anomaly THEN 1 END) AS anomaly_records FROM sensors"),
    "distinct_equipment": _with(SENSORS) + "SELECT DISTINCT equipment_id FROM sensors",
    "layer_row_counts": _with(SENSORS, CLEAN, SILVER, KPI) + (
        "SELECT 'bronze' AS layer, COUNT(*) AS \"rows\" FROM sensors UNION ALL "
        "SELECT 'silver', COUNT(*) FROM silver UNION ALL SELECT 'gold', COUNT(*) FROM kpi"),
    "check_not_null": _with(SENSORS) + "SELECT * FROM sensors WHERE event_id IS NULL",
    "check_unique": _with(SENSORS) + (
        "SELECT event_id, COUNT(*) AS n_records FROM sensors WHERE event_id IS NOT NULL "
        "GROUP BY event_id HAVING COUNT(*) > 1"),
    "check_accepted_values": _with(SENSORS) + (
        "SELECT * FROM sensors WHERE equipment_id NOT IN ('EQ-001', 'EQ-002', 'EQ-003', 'EQ-004', 'EQ-005')"),
    "check_expression": _with(SENSORS) + "SELECT * FROM sensors WHERE NOT (temp_coolant_c BETWEEN 50 AND 130)",
    "data_checks_bronze": _with(SENSORS, LABELLED) + _checks_report("labelled"),
    "data_checks_silver": _with(SENSORS, CLEAN, SILVER) + _checks_report("silver"),
}


# Normal operating envelope per type (fixed values, written out here so that
# the oracle does not share them with the library): rpm, coolant, oil, oil
# pressure, fuel rate, NOx, PM2.5, CO2, load; lowest and highest.
ENVELOPES = """
  ('excavator', 600, 1800, 75, 105, 80, 120, 2.5, 5.5, 15, 45, 50, 350, 0.5, 8.0, 3.5, 8.0, 20, 95),
  ('bulldozer', 700, 1900, 80, 108, 85, 125, 3.0, 6.0, 20, 55, 60, 400, 0.8, 10.0, 4.0, 9.0, 30, 100),
  ('wheel_loader', 650, 1750, 75, 102, 78, 118, 2.8, 5.8, 12, 40, 40, 300, 0.4, 7.0, 3.0, 7.5, 15, 90),
  ('dump_truck', 600, 2000, 80, 110, 85, 130, 3.5, 6.5, 25, 65, 80, 450, 1.0, 12.0, 4.5, 10.0, 40, 100),
  ('motor_grader', 650, 1800, 75, 100, 80, 115, 2.5, 5.5, 10, 35, 35, 280, 0.3, 6.0, 3.0, 7.0, 10, 85)"""


def _envelope_values() -> str:
    metrics = _METRICS.split(", ")
    cols = ", ".join(f"lo{i}, hi{i}" for i in range(9))
    rows = " UNION ALL ".join(f"SELECT t, '{m}', CAST(lo{i} AS DOUBLE), CAST(hi{i} AS DOUBLE) FROM env_wide"
                              for i, m in enumerate(metrics))
    return (f"env_wide(t, {cols}) AS (VALUES {ENVELOPES}), "
            f"env(equipment_type, metric, lo, hi) AS ({rows})")


_METRICS = ("rpm, temp_coolant_c, temp_oil_c, pressure_oil_bar, fuel_rate_lh, nox_ppm, "
            "pm25_mg_m3, co2_pct, load_pct")

ORACLE_SQL.update({
    "bronze_json_scan": _with(SENSORS) + "SELECT * FROM sensors",
    "idempotent_append": _with(SENSORS) + "SELECT DISTINCT * FROM sensors",
    "silver_job": _with(SENSORS, CLEAN, SILVER) + "SELECT * FROM silver",
    "incremental_refresh": _with(SENSORS, CLEAN, SILVER) + "SELECT * FROM silver",
    "gold_table": _with(SENSORS, CLEAN, SILVER, KPI) + f"SELECT {GOLD_COLS} FROM kpi",
    "type_envelope_check": _with(SENSORS, CLEAN, _envelope_values()) + (
        "SELECT u.equipment_type, u.metric, COUNT(u.value) AS readings, "
        "COUNT(CASE WHEN u.value < e.lo THEN 1 END) AS below, "
        "COUNT(CASE WHEN u.value > e.hi THEN 1 END) AS above "
        f"FROM (UNPIVOT (SELECT equipment_type, {_METRICS} FROM clean) ON {_METRICS} "
        "INTO NAME metric VALUE value) u JOIN env e ON u.equipment_type = e.equipment_type "
        "AND u.metric = e.metric GROUP BY u.equipment_type, u.metric"),
    "stream_ingest": _with(SENSORS) + "SELECT DISTINCT * FROM sensors",
    "distinct_by_sketch": _with(SENSORS) + (
        "SELECT substr(ingestion_date, 1, 7) AS month, "
        "COUNT(DISTINCT equipment_id) + MAX(CASE WHEN equipment_id IS NULL THEN 1 ELSE 0 END) AS machines, TRUE AS machines_near, "
        "COUNT(DISTINCT event_id) + MAX(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END) AS events, TRUE AS events_near "
        "FROM sensors GROUP BY substr(ingestion_date, 1, 7)"),
    "stream_ingest_state": _with(SENSORS) + "SELECT DISTINCT * FROM sensors",
    "stream_daily_counts": _with(SENSORS) + (
        "SELECT CAST(CAST(CAST(timestamp AS TIMESTAMP) AS DATE) AS VARCHAR) AS event_date, equipment_id, "
        "COUNT(event_id) AS total_readings, COUNT(CASE WHEN is_anomaly THEN 1 END) AS total_anomalies, "
        "COUNT(CASE WHEN nox_ppm > 350 THEN 1 END) AS nox_violations, "
        "COUNT(CASE WHEN temp_coolant_c > 105 THEN 1 END) AS overheating_events "
        "FROM sensors GROUP BY 1, 2"),
    "stream_windowed_counts": _with(SENSORS) + (
        "SELECT CAST(CAST(CAST(timestamp AS TIMESTAMP) AS DATE) AS VARCHAR) AS event_date, equipment_id, "
        "COUNT(event_id) AS total_readings, COUNT(CASE WHEN is_anomaly THEN 1 END) AS total_anomalies, "
        "COUNT(CASE WHEN nox_ppm > 350 THEN 1 END) AS nox_violations, "
        "COUNT(CASE WHEN temp_coolant_c > 105 THEN 1 END) AS overheating_events, "
        # the last file holds every 17th reading of the first ten days, whose windows are closed by then
        "COUNT(CASE WHEN CAST(substr(event_id, 3) AS BIGINT) % 17 = 0 AND CAST(ingestion_date AS DATE) < "
        "(SELECT CAST(min(ingestion_date) AS DATE) FROM sensors) + 10 THEN 1 END) AS late_readings "
        "FROM sensors GROUP BY 1, 2"),
    "stream_daily_kpis": _with(SENSORS, CLEAN, SILVER, KPI) + f"SELECT {GOLD_COLS}, engine_issues FROM kpi",
    "stream_prev_delta": _with(SENSORS, CLEAN, SILVER) + (
        "SELECT event_id, equipment_id, timestamp, rpm, rpm_prev, rpm_delta, temp_coolant_c, "
        "temp_coolant_prev, temp_coolant_delta FROM silver"),
})


# --- layers under re-sends, gaps and junk -----------------------------------

_SILVER_FULL = _with(SENSORS, CLEAN, SILVER) + "SELECT * FROM silver"


def _over(table: str, *ctes: str) -> tuple[str, ...]:
    """The statements over another readings table."""
    return tuple(c.replace("FROM sensors ", f"FROM {table} ") for c in ctes)


_NUMBER = "CAST(substr(event_id, 3) AS BIGINT)"
_FIRST_DAY = "(SELECT CAST(min(ingestion_date) AS DATE) FROM sensors)"
_GAPPED = f"""
gapped AS (SELECT * FROM sensors WHERE CAST(ingestion_date AS DATE) = {_FIRST_DAY}
           OR CAST(ingestion_date AS DATE) >= {_FIRST_DAY} + 9)"""
_RESENT = f"""
resent AS (SELECT * FROM sensors UNION ALL
  SELECT * REPLACE (CAST(CAST(timestamp AS TIMESTAMP) - INTERVAL 1 HOUR AS VARCHAR) AS timestamp,
                    CAST({_FIRST_DAY} + 5 AS VARCHAR) AS ingestion_date)
  FROM sensors WHERE {_NUMBER} % 7 = 0 AND CAST(ingestion_date AS DATE) = {_FIRST_DAY} + 2)"""
_JUNK = (f"(event_id IS NOT NULL AND ({_NUMBER} % 101 = 0 OR {_NUMBER} % 103 = 0 "
         f"OR {_NUMBER} % 107 = 0 OR {_NUMBER} % 109 = 0))")
_TAMPERED = """
tampered AS (SELECT * REPLACE (
    CASE WHEN nox_ppm > 440 THEN 'EXTREME' ELSE emissions_severity END AS emissions_severity,
    CASE WHEN rpm > 2900 THEN 'RUNAWAY' ELSE engine_status END AS engine_status) FROM labelled)"""
_NARROW = f"""
narrow AS (SELECT {SENSOR_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY CAST(timestamp AS TIMESTAMP) ASC NULLS LAST, {PAYLOAD_ORDER}) AS rn
    FROM sensors WHERE {" AND ".join(_rule(*r) for r in NB_RULES)} AND event_id IS NOT NULL) WHERE rn = 1)"""

_INT, _TEXT, _BOOL = ("equipment_year",), ("event_id", "equipment_id", "equipment_type", "equipment_model", "timestamp",
                                           "anomaly_flags", "ingestion_date"), ("is_anomaly",)


def _profile() -> str:
    kind = lambda c: "int" if c in _INT else "string" if c in _TEXT else "boolean" if c in _BOOL else "double"
    return " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS position, '{c}' AS \"column\", '{kind(c)}' AS type, "
        f"COUNT(*) AS \"rows\", COUNT(*) - COUNT({c}) AS nulls FROM sensors" for k, c in enumerate(SENSOR_COLS.split(", ")))


ORACLE_SQL.update({
    "catalog_tables": _with(SENSORS, CLEAN, SILVER, KPI) + (
        "SELECT 'bronze' AS table_name, COUNT(*) AS \"rows\" FROM sensors UNION ALL "
        "SELECT 'silver', COUNT(*) FROM clean UNION ALL SELECT 'gold', COUNT(*) FROM kpi"),
    "layer_profile": _with(SENSORS) + _profile(),
    "records_by_client": _with(SENSORS) + (
        f"SELECT {SENSOR_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY event_id "
        f"ORDER BY CAST(timestamp AS TIMESTAMP) ASC NULLS LAST, {PAYLOAD_ORDER}) AS rn "
        "FROM sensors WHERE event_id IS NOT NULL) WHERE rn = 1 ORDER BY event_id DESC LIMIT 20"),
    "incremental_gap": _with(SENSORS, _GAPPED, *_over("gapped", CLEAN), SILVER) + "SELECT * FROM silver",
    "incremental_middle_day": _SILVER_FULL,
    "incremental_split_dates": _SILVER_FULL,
    "incremental_resent_id": _with(SENSORS, _RESENT, *_over("resent", CLEAN), SILVER) + "SELECT * FROM silver",
    "gold_by_deltas": _with(SENSORS, _RESENT, *_over("resent", CLEAN), SILVER, KPI) + f"SELECT {GOLD_COLS} FROM kpi",
    "bronze_quarantine": _with(SENSORS) + (
        f"SELECT DISTINCT 'good' AS kind, event_id, NULL AS raw_record FROM sensors WHERE NOT {_JUNK} UNION ALL "
        f"SELECT DISTINCT 'quarantined', NULL, CASE WHEN {_NUMBER} % 101 = 0 "
        "THEN '{\"event_id\": \"' || event_id || '\", ' "
        f"WHEN {_NUMBER} % 103 = 0 THEN '{{\"event_id\":\"' || event_id || '\",\"rpm\":\"abc\"}}' "
        f"WHEN {_NUMBER} % 107 = 0 THEN '{{}}' ELSE '[' END FROM sensors WHERE {_JUNK}"),
    "idempotent_append_resent": _with(SENSORS) + (
        "SELECT DISTINCT * REPLACE (CASE WHEN event_id IS NOT NULL AND "
        f"{_NUMBER} % 13 = 0 THEN NULL ELSE ingestion_date END AS ingestion_date) FROM sensors"),
    "data_checks_tampered": _with(SENSORS, LABELLED, _TAMPERED) + _checks_report("tampered"),
    "data_checks_incremental": _with(SENSORS, LABELLED, _TAMPERED) + _checks_report("tampered"),
    "catalog_roundtrip": _with(SENSORS, CLEAN) + "SELECT * FROM clean",
    "bucketed_append": _with(SENSORS) + f"SELECT DISTINCT * FROM sensors WHERE CAST(ingestion_date AS DATE) >= {_FIRST_DAY} + 10",
    "zordered_table": _with(SENSORS, CLEAN) + "SELECT * FROM clean",
    "layer_stamps": _with(SENSORS, CLEAN, SILVER, KPI) + (
        "SELECT 'bronze' AS layer, n AS \"rows\", n AS ingested, n AS sourced, n AS versioned, "
        "CAST(0 AS BIGINT) AS transformed, CAST(0 AS BIGINT) AS updated "
        "FROM (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM sensors)) UNION ALL "
        "SELECT 'silver', COUNT(*), COUNT(*), COUNT(*), COUNT(*), COUNT(*), 0 FROM silver UNION ALL "
        "SELECT 'gold', COUNT(*), 0, 0, 0, 0, COUNT(*) FROM kpi"),
    "silver_narrow": _with(SENSORS, _NARROW) + (
        "SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp), "
        "CAST(hour(CAST(timestamp AS TIMESTAMP)) AS INTEGER) AS hour_of_day, "
        f"{SEVERITY} AS emissions_severity, {STATUS} AS engine_status FROM narrow"),
    "gold_narrow": _with(SENSORS, CLEAN, SILVER, KPI) + (
        f"SELECT {COMPACT_COLS} FROM kpi").replace("avg_pm25_mg_m3", "avg_pm25_mg_m3 AS avg_pm25")
        .replace("total_fuel_consumed_l", "total_fuel_consumed_l AS total_fuel_lh")
        .replace("equipment_health_status", "equipment_health_status AS equipment_health"),
    "sample_by_id": _with(SENSORS, CLEAN) + "SELECT * FROM clean ORDER BY event_id LIMIT 20",
    "stream_ingest": _with(SENSORS) + f"SELECT DISTINCT * FROM sensors WHERE NOT {_JUNK}",
    "bronze_drift": _with(SENSORS) + (
        f"SELECT event_id, CASE WHEN {_NUMBER} % 22 = 0 THEN 'firmware,vibration_mm_s' ELSE 'vibration_mm_s' END AS fields, "
        f"{_NUMBER} % 37 AS vibration_mm_s, "
        f"CASE WHEN {_NUMBER} % 22 = 0 THEN 'v' || CAST({_NUMBER} % 5 AS VARCHAR) END AS firmware, equipment_id "
        f"FROM (SELECT DISTINCT * FROM sensors) WHERE event_id IS NOT NULL AND {_NUMBER} % 11 = 0"),
})
