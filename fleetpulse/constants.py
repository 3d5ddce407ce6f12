"""Schemas and business constants of the telemetry layers.

Everything below the "FIXED VALUES" banner must keep these exact values for
results to agree with the original pipeline; the rest of the library only
reads them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original pipeline's rules, thresholds and labels)
# ---------------------------------------------------------------------------

# Raw sensor reading, in declared order. The three non-nullable fields are
# not enforced by file readers; the not_null check enforces them instead.
SENSOR_SCHEMA = StructType([
    StructField("event_id", StringType(), False),
    StructField("equipment_id", StringType(), False),
    StructField("equipment_type", StringType(), True),
    StructField("equipment_model", StringType(), True),
    StructField("equipment_year", IntegerType(), True),
    StructField("timestamp", StringType(), False),
    StructField("rpm", DoubleType(), True),
    StructField("temp_coolant_c", DoubleType(), True),
    StructField("temp_oil_c", DoubleType(), True),
    StructField("pressure_oil_bar", DoubleType(), True),
    StructField("fuel_rate_lh", DoubleType(), True),
    StructField("nox_ppm", DoubleType(), True),
    StructField("pm25_mg_m3", DoubleType(), True),
    StructField("co2_pct", DoubleType(), True),
    StructField("load_pct", DoubleType(), True),
    StructField("is_anomaly", BooleanType(), True),
    StructField("location_lat", DoubleType(), True),
    StructField("location_lon", DoubleType(), True),
    StructField("anomaly_flags", StringType(), True),
    StructField("ingestion_date", StringType(), True),
])

# Silver quality rules: metric -> (min, max), both bounds inclusive.
QUALITY_RULES: dict[str, tuple[float, float]] = {
    "rpm": (0, 3000),
    "temp_coolant_c": (50, 130),
    "temp_oil_c": (50, 150),
    "pressure_oil_bar": (0.5, 10.0),
    "fuel_rate_lh": (0, 100),
    "nox_ppm": (0, 1000),
    "pm25_mg_m3": (0, 50),
    "co2_pct": (0, 20),
    "load_pct": (0, 100),
}

# The six-metric variant of the silver rules (chained filters, no fuel, CO2, load).
SIX_METRIC_QUALITY_RULES: dict[str, tuple[float, float]] = {
    "rpm": (0, 3000),
    "temp_coolant_c": (50, 130),
    "temp_oil_c": (50, 150),
    "pressure_oil_bar": (0.5, 10.0),
    "nox_ppm": (0, 1000),
    "pm25_mg_m3": (0, 50),
}

# Emission severity on nox_ppm, strict thresholds, first match wins.
SEVERITY_LEVELS: list[tuple[float, str]] = [
    (400, "CRITICAL"),
    (350, "HIGH"),
    (200, "MEDIUM"),
]
SEVERITY_DEFAULT = "NORMAL"

# Engine status, first match wins: (column, operator, threshold, label).
ENGINE_STATUS_RULES: list[tuple[str, str, float, str]] = [
    ("temp_coolant_c", ">", 105, "OVERHEATING"),
    ("pressure_oil_bar", "<", 2.5, "LOW_OIL_PRESSURE"),
    ("rpm", ">", 2000, "HIGH_RPM"),
]
ENGINE_STATUS_DEFAULT = "NORMAL"

# Anomaly flag codes, in output order: (column, operator, threshold, code).
ANOMALY_FLAG_RULES: list[tuple[str, str, float, str]] = [
    ("temp_coolant_c", ">", 105, "HIGH_TEMP_COOLANT"),
    ("temp_oil_c", ">", 120, "HIGH_TEMP_OIL"),
    ("pressure_oil_bar", "<", 2.5, "LOW_PRESSURE_OIL"),
    ("nox_ppm", ">", 350, "HIGH_NOX"),
    ("pm25_mg_m3", ">", 8.0, "HIGH_PM25"),
]

# Gold compliance violations: nox > 350, pm25 > 8.0, coolant > 105,
# oil pressure < 2.5. Weights of the compliance score: 2.0, 1.5, 1.0.
NOX_LIMIT = 350
PM25_LIMIT = 8.0
COOLANT_LIMIT = 105
OIL_PRESSURE_LIMIT = 2.5

# Compliance score: 100 minus these weights times the percentage of readings
# with the violation.
COMPLIANCE_WEIGHTS: dict[str, float] = {
    "nox_violations": 2.0,
    "pm25_violations": 1.5,
    "overheating_events": 1.0,
}

# Health banding on the rounded anomaly rate (percent), first match wins.
HEALTH_LEVELS: list[tuple[float, str]] = [
    (20, "CRITICAL"),
    (10, "WARNING"),
    (5, "ATTENTION"),
]
HEALTH_DEFAULT = "HEALTHY"

# Accepted values of the silver data tests.
ACCEPTED_EQUIPMENT_IDS = ["EQ-001", "EQ-002", "EQ-003", "EQ-004", "EQ-005"]
ACCEPTED_EQUIPMENT_TYPES = ["excavator", "bulldozer", "wheel_loader", "dump_truck", "motor_grader"]
ACCEPTED_SEVERITIES = ["NORMAL", "MEDIUM", "HIGH", "CRITICAL"]
ACCEPTED_ENGINE_STATUSES = ["NORMAL", "OVERHEATING", "LOW_OIL_PRESSURE", "HIGH_RPM"]

# Normal operating envelope per equipment type: metric -> (lo, hi).
# Metrics in order: rpm, temp_coolant, temp_oil, pressure_oil, fuel_rate,
# nox_ppm, pm25_mg, co2_pct, load_pct.
TYPE_ENVELOPES: dict[str, dict[str, tuple[float, float]]] = {
    "excavator": {"rpm": (600, 1800), "temp_coolant": (75, 105), "temp_oil": (80, 120),
                  "pressure_oil": (2.5, 5.5), "fuel_rate": (15, 45), "nox_ppm": (50, 350),
                  "pm25_mg": (0.5, 8.0), "co2_pct": (3.5, 8.0), "load_pct": (20, 95)},
    "bulldozer": {"rpm": (700, 1900), "temp_coolant": (80, 108), "temp_oil": (85, 125),
                  "pressure_oil": (3.0, 6.0), "fuel_rate": (20, 55), "nox_ppm": (60, 400),
                  "pm25_mg": (0.8, 10.0), "co2_pct": (4.0, 9.0), "load_pct": (30, 100)},
    "wheel_loader": {"rpm": (650, 1750), "temp_coolant": (75, 102), "temp_oil": (78, 118),
                     "pressure_oil": (2.8, 5.8), "fuel_rate": (12, 40), "nox_ppm": (40, 300),
                     "pm25_mg": (0.4, 7.0), "co2_pct": (3.0, 7.5), "load_pct": (15, 90)},
    "dump_truck": {"rpm": (600, 2000), "temp_coolant": (80, 110), "temp_oil": (85, 130),
                   "pressure_oil": (3.5, 6.5), "fuel_rate": (25, 65), "nox_ppm": (80, 450),
                   "pm25_mg": (1.0, 12.0), "co2_pct": (4.5, 10.0), "load_pct": (40, 100)},
    "motor_grader": {"rpm": (650, 1800), "temp_coolant": (75, 100), "temp_oil": (80, 115),
                     "pressure_oil": (2.5, 5.5), "fuel_rate": (10, 35), "nox_ppm": (35, 280),
                     "pm25_mg": (0.3, 6.0), "co2_pct": (3.0, 7.0), "load_pct": (10, 85)},
}

# Envelope metric name -> reading column.
ENVELOPE_COLUMNS = {
    "rpm": "rpm",
    "temp_coolant": "temp_coolant_c",
    "temp_oil": "temp_oil_c",
    "pressure_oil": "pressure_oil_bar",
    "fuel_rate": "fuel_rate_lh",
    "nox_ppm": "nox_ppm",
    "pm25_mg": "pm25_mg_m3",
    "co2_pct": "co2_pct",
    "load_pct": "load_pct",
}

PIPELINE_VERSION = "1.0.0"

# ---------------------------------------------------------------------------
# Layer layout (our own choices)
# ---------------------------------------------------------------------------

GROUP_KEYS = ["equipment_id", "equipment_type", "equipment_model", "equipment_year", "ingestion_date"]
BRONZE_PARTITIONS = ["ingestion_date", "equipment_type"]
SILVER_PARTITIONS = ["ingestion_date", "equipment_type"]
GOLD_PARTITIONS = ["ingestion_date"]
GOLD_CLUSTER_BY = ["equipment_id", "equipment_type"]

# Metric columns of a reading, in schema order.
METRIC_COLUMNS = [
    "rpm", "temp_coolant_c", "temp_oil_c", "pressure_oil_bar", "fuel_rate_lh",
    "nox_ppm", "pm25_mg_m3", "co2_pct", "load_pct",
]
SENSOR_COLUMNS = [f.name for f in SENSOR_SCHEMA.fields]
STAMP_COLUMNS = ["_ingested_at", "_transformed_at", "_updated_at"]
