"""Sensor readings derived from the shared ``events`` table.

The test tables hold no sensor data, so every checked query starts from this
derivation: each event becomes one reading whose metrics are integer hashes of
the event number, scaled by one division so that any SQL engine computes the
same doubles. It deliberately contains what a clean simulator never emits:
repeated events, NULL ids and metrics, out-of-range values and a NULL group
key. One scan of ``events``; the repeated rows come from a generator, not from
a second scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..constants import SENSOR_COLUMNS

# FIXED VALUES of the derivation (shared with the SQL oracle):
# every 50th event is sent twice, every 997th has no event_id, every 89th has
# no rpm, every 211th gets +30.0 C of coolant; machine = user_id % 5. Further
# rows break the data tests: an unknown machine, none, an unknown type, none,
# negative NOx, none, and no coolant temperature.
REPEAT_EVERY = 50
NULL_ID_EVERY = 997
NULL_RPM_EVERY = 89
HOT_COOLANT_EVERY = 211
UNKNOWN_MACHINE_EVERY = 149
NO_MACHINE_EVERY = 241
UNKNOWN_TYPE_EVERY = 173
NO_TYPE_EVERY = 181
NEGATIVE_NOX_EVERY = 193
NO_NOX_EVERY = 227
NO_COOLANT_EVERY = 229
EQUIPMENT_TYPES = ["excavator", "bulldozer", "wheel_loader", "dump_truck", "motor_grader"]
EQUIPMENT_MODELS = ["M-A", "M-B", "M-C", "M-D", None]


def _scaled(base: int, mult: int, mod: int, div: int) -> str:
    """(base + (n * mult) % mod) / div, exact in 64-bit integers."""
    return f"CAST({base} + (n * {mult}) % {mod} AS DOUBLE) / {div}"


def _pick(values: list) -> str:
    branches = " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CAST(CASE u {branches} END AS STRING)"


def sensors_from_events(events: DataFrame) -> DataFrame:
    """Map an ``events`` DataFrame to the 20-column raw reading layout."""
    base = events.selectExpr(
        "event_id AS n", "ts", "user_id % 5 AS u", "event_type",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        f"explode(CASE WHEN event_id % {REPEAT_EVERY} = 0 THEN array(0, 1) ELSE array(0) END) AS _copy",
    )
    s = base.selectExpr(
        f"CASE WHEN n % {NULL_ID_EVERY} = 0 THEN CAST(NULL AS STRING) ELSE concat('E-', CAST(n AS STRING)) END"
        " AS event_id",
        f"CASE WHEN n % {UNKNOWN_MACHINE_EVERY} = 0 THEN 'EQ-999' WHEN n % {NO_MACHINE_EVERY} = 0 THEN NULL"
        " ELSE concat('EQ-00', CAST(u + 1 AS STRING)) END AS equipment_id",
        f"CASE WHEN n % {UNKNOWN_TYPE_EVERY} = 0 THEN 'crane' WHEN n % {NO_TYPE_EVERY} = 0 THEN NULL"
        f" ELSE {_pick(EQUIPMENT_TYPES)} END AS equipment_type",
        f"{_pick(EQUIPMENT_MODELS)} AS equipment_model",
        "CAST(2019 + u AS INT) AS equipment_year",
        "CAST(date_trunc('second', ts) AS STRING) AS timestamp",
        f"CASE WHEN n % {NULL_RPM_EVERY} = 0 THEN CAST(NULL AS DOUBLE) ELSE {_scaled(5000, 7919, 26000, 10)} END"
        " AS rpm",
        f"CASE WHEN n % {NO_COOLANT_EVERY} = 0 THEN CAST(NULL AS DOUBLE) ELSE "
        f"CAST(700 + (n * 104729) % 400 + CASE WHEN n % {HOT_COOLANT_EVERY} = 0 THEN 300 ELSE 0 END AS DOUBLE)"
        " / 10 END AS temp_coolant_c",
        f"{_scaled(780, 1299709, 500, 10)} AS temp_oil_c",
        f"{_scaled(200, 15485863, 450, 100)} AS pressure_oil_bar",
        f"{_scaled(1000, 31337, 5500, 100)} AS fuel_rate_lh",
        f"CASE WHEN n % {NEGATIVE_NOX_EVERY} = 0 THEN CAST(-1 AS DOUBLE) WHEN n % {NO_NOX_EVERY} = 0"
        f" THEN CAST(NULL AS DOUBLE) ELSE {_scaled(350, 27644437, 4200, 10)} END AS nox_ppm",
        f"{_scaled(30, 6700417, 1170, 100)} AS pm25_mg_m3",
        f"{_scaled(300, 2147483, 700, 100)} AS co2_pct",
        "CAST(k AS DOUBLE) AS load_pct",
        "(event_type = 'error' AND k < 50) AS is_anomaly",
        "CAST(-23550500 + (n * 3571) % 500000 AS DOUBLE) / 1000000 AS location_lat",
        "CAST(-46633300 + (n * 6113) % 500000 AS DOUBLE) / 1000000 AS location_lon",
        "CAST(CAST(ts AS DATE) AS STRING) AS ingestion_date",
    )
    # Imported here to keep the module graph acyclic (functions -> constants).
    from ..functions.columns import anomaly_flags
    return s.withColumn("anomaly_flags", anomaly_flags()).select(*SENSOR_COLUMNS)


def load_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read ``events`` from a table folder and derive the readings."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return sensors_from_events(events)
