import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from fleetpulse.session import DEFAULT_CONF
    b = (SparkSession.builder.master("local[*]").appName("fleetpulse-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fleetpulse-test-wh-")))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only where the session has none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fleetpulse-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir(spark):
    from fleetpulse.session import scratch_path
    return scratch_path(spark, "test")


def reading(**kw):
    """One raw reading with in-range defaults; override any field."""
    base = dict(
        event_id="E-1", equipment_id="EQ-001", equipment_type="excavator", equipment_model="M-A",
        equipment_year=2020, timestamp="2024-01-01 10:00:00", rpm=1000.0, temp_coolant_c=90.0,
        temp_oil_c=100.0, pressure_oil_bar=4.0, fuel_rate_lh=30.0, nox_ppm=100.0, pm25_mg_m3=2.0,
        co2_pct=5.0, load_pct=50.0, is_anomaly=False, location_lat=-23.5, location_lon=-46.6,
        anomaly_flags=None, ingestion_date="2024-01-01",
    )
    base.update(kw)
    return base


def to_df(spark, rows):
    from fleetpulse.constants import SENSOR_COLUMNS, SENSOR_SCHEMA
    from pyspark.sql.types import StructField, StructType
    schema = StructType([StructField(f.name, f.dataType, True) for f in SENSOR_SCHEMA.fields])
    return spark.createDataFrame([tuple(r[c] for c in SENSOR_COLUMNS) for r in rows], schema)
