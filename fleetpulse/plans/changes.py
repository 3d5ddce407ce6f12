"""Silver's change log: what every refresh took away and put in, beside the table.

``<silver>_changes/set=N`` holds the rows of refresh N that differ in a column that gold reads:
``_sign`` is -1 for a row as it was, 1 as it is now, and 0 where only
the group is known to have changed. A set counts once its marker ``_complete`` exists, which a refresh creates
after silver is written. A refresh that died leaves a set without it; the next
one writes the groups of both attempts with sign 0, since nobody knows which of the
dead one's partitions were replaced. A full build leaves a set with the marker ``_full`` instead of
rows. Recording begins with ``changes=True`` and goes on for every later refresh.

The log is read and written by one job at a time, like silver itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import GROUP_KEYS, METRIC_COLUMNS
from ..sinks.writers import folder_names, make_folder, path_exists, remove_path
from ..sources.layers import SILVER_SCHEMA

BESIDE = "_changes"
COLUMNS = ["event_id", *GROUP_KEYS, "is_anomaly", *METRIC_COLUMNS]
SCHEMA = ", ".join(f"{c} {SILVER_SCHEMA[c].dataType.simpleString()}" for c in COLUMNS) + ", _sign bigint"


def _sets(spark: SparkSession, log: str) -> list[int]:
    return sorted(int(m[1]) for m in map(re.compile(r"set=(\d+)").fullmatch, folder_names(spark, log)) if m)


def is_complete(spark: SparkSession, log: str, number: int) -> bool:
    return path_exists(spark, f"{log}/set={number}/_complete")


def begin(spark: SparkSession, log: str) -> int:
    """The number of the set to write: a new one, or that of a refresh that died."""
    numbers = _sets(spark, log)
    if numbers and not is_complete(spark, log, numbers[-1]):
        return numbers[-1]
    number = (numbers[-1] if numbers else 0) + 1
    make_folder(spark, f"{log}/set={number}")
    return number


def _attempts(spark: SparkSession, folder: str) -> int:
    """Attempts of a set that wrote all their rows (the last may have changed silver)."""
    n = 0
    while path_exists(spark, f"{folder}/attempt={n}/_SUCCESS"):
        n += 1
    return n


def record(spark: SparkSession, log: str, number: int, old: DataFrame, new: DataFrame) -> None:
    """Write how ``new`` differs from ``old``; to be called before silver is changed."""
    folder = f"{log}/set={number}"
    n = _attempts(spark, folder)
    rows = net(old.select(*COLUMNS, F.lit(-1).cast("long").alias("_sign"))
               .unionByName(new.select(*COLUMNS, F.lit(1).cast("long").alias("_sign"))))
    if n:
        rows = (rows.unionByName(spark.read.schema(SCHEMA).parquet(f"{folder}/attempt={n - 1}"))
                .select(*GROUP_KEYS).distinct().withColumn("_sign", F.lit(0).cast("long")))
        rows = spark.createDataFrame([], SCHEMA).unionByName(rows, allowMissingColumns=True)
    rows.write.mode("overwrite").parquet(f"{folder}/attempt={n}")


def record_full(spark: SparkSession, log: str, number: int) -> None:
    make_folder(spark, f"{log}/set={number}/_full")


def complete(spark: SparkSession, log: str, number: int) -> None:
    make_folder(spark, f"{log}/set={number}/_complete")


def net(rows: DataFrame) -> DataFrame:
    """Rows that came and went again cancel out; sign 0 stays."""
    known = rows.filter("_sign <> 0").groupBy(*COLUMNS).agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0")
    return known.unionByName(rows.filter("_sign = 0"))


def since(spark: SparkSession, log: str, applied: int) -> tuple[int, bool, DataFrame | None]:
    """The last complete set, whether one after ``applied`` was a full build, and the net
    changes after ``applied`` (None where there are no such sets)."""
    numbers = [n for n in _sets(spark, log) if n > applied and is_complete(spark, log, n)]
    if not numbers:
        return applied, False, None
    full = any(path_exists(spark, f"{log}/set={n}/_full") for n in numbers)
    paths = [f"{log}/set={n}/attempt={a - 1}" for n in numbers if (a := _attempts(spark, f"{log}/set={n}"))]
    rows = spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    return numbers[-1], full, net(rows)


def forget(spark: SparkSession, silver_path: str, applied: int) -> None:
    """Delete the sets up to ``applied`` that every reader has applied; the newest set stays."""
    log = silver_path.rstrip("/") + BESIDE
    for n in _sets(spark, log)[:-1]:
        if n <= applied:
            remove_path(spark, f"{log}/set={n}")
