"""Session helpers: a local session for tests and the shared scratch root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on. AQE re-plans shuffles at run
# time (partition coalescing, skew join splitting); the time zone pins the
# meaning of offset-less timestamps.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# What a session needs for a table format whose jar is on its class path
# (``spark.jars`` or ``spark.jars.packages`` among the caller's options).
TABLE_FORMATS = {
    "parquet": {},
    "delta": {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    },
    "iceberg": {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        "spark.sql.catalog.spark_catalog": "org.apache.iceberg.spark.SparkSessionCatalog",
    },
}


def session_options(table_format: str = "parquet", extra: dict | None = None) -> dict[str, str]:
    """All options of a session: the defaults, those of the table format, and the
    caller's, which win; extensions of both are kept."""
    of_format = TABLE_FORMATS[table_format]
    options = {**DEFAULT_CONF, **of_format, **{k: str(v) for k, v in (extra or {}).items()}}
    names = [o.get("spark.sql.extensions") for o in (of_format, extra or {})]
    if any(names):
        options["spark.sql.extensions"] = ",".join(dict.fromkeys(n for part in names if part for n in part.split(",")))
    return options


def _driver_memory() -> str:
    """Local driver heap: 60% of physical memory, at most 8 GB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(8, int(total * 0.6) >> 30))}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fleetpulse",
                  extra: dict | None = None, table_format: str = "parquet") -> SparkSession:
    """A local session for tests and benchmarks, with ``session_options``. On a cluster use
    the session the platform hands you; the library never builds its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", _driver_memory()))
    for k, v in session_options(table_format, extra).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only where it is unset and the master is local
    (tests, benchmarks) is a fresh folder created and registered; on a cluster
    a machine-local folder would not be shared, so that raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="fleetpulse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _scratch_root(spark: SparkSession) -> str:
    """This application's folder under the shared checkpoint root."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetpulse/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root, for data a job
    writes and reads back (staged tables, stream sources, sink outputs)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application staged. Lazy results that read staged
    tables must be written first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
