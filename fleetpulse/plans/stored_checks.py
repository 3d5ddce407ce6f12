"""Data checks kept up to date: after a refresh only the changed dates are scanned.

Beside a layer partitioned by ingestion date lie, for one suite of checks, summaries that add up:

* ``rows``: failing rows per (date, row-level check);
* ``values``: for the columns that must be unique, rows per (date, hash of the value), 16
  bytes a value instead of a reading, sorted by bucket of the hash;
* ``repeats``: the values that occur more than once, with their exact number of rows;
* ``files``: the layer's data files that the summaries hold.

An update lists the layer, scans the dates whose files differ and replaces their rows and
values. A value can only have become, or ceased to be, a repeat if its hash's rows in
a changed date differ; the other dates' values of these hashes, found in their buckets only, say which
now occur twice. These are counted in the layer by the value itself (hashes may
collide), in the dates that hold them. All other repeats stay as they are.

Crash safety: ``repeats`` and ``files`` are generations, and one is in force once its files
are written, last of all. The changed hashes are written before the values are
touched, and an update that finds those of an attempt that died takes them as
changed too. One job at a time, like the layer.

Defined results: NULL values are no repeats; values are compared by their text; rows without a
date are a date of their own; a layer that lost all its dates, or has none yet, fails nothing.
"""

from __future__ import annotations

import re
from hashlib import sha256
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.checks import SILVER_CHECKS, Check, failing_condition
from ..session import scratch_path
from ..sinks.id_index import data_files
from ..sinks.writers import folder_names, overwrite_partitioned, path_exists, rebalanced, remove_path
from ..sources.layers import SILVER_SCHEMA, read_layer
from .silver import in_dates, partition_dir

BESIDE = "_checks"
BUCKETS = 1024
DATE = "ingestion_date"
_SCHEMAS = {
    "rows": "position int, failing bigint, ingestion_date string",
    "values": "column string, bucket int, h bigint, n bigint, ingestion_date string",
    "repeats": "column string, h bigint, value string, n bigint",
    "files": "file string",
    "pending": "column string, bucket int, h bigint",
}


def _folder(path: str, checks: list[Check]) -> str:
    suite = sha256(repr(checks).encode()).hexdigest()[:16]
    return f"{path.rstrip('/')}{BESIDE}/suite={suite}"


def _read(spark: SparkSession, state: str, kind: str, generation: int | None = None) -> DataFrame:
    folder = f"{state}/{kind}" + ("" if generation is None else f"/gen={generation}")
    if not path_exists(spark, folder):
        return spark.createDataFrame([], _SCHEMAS[kind])
    return spark.read.schema(_SCHEMAS[kind]).parquet(folder)


def _in_force(spark: SparkSession, state: str) -> int:
    numbers = [int(m[1]) for m in map(re.compile(r"gen=(\d+)").fullmatch, folder_names(spark, f"{state}/files")) if m]
    return max((n for n in numbers if path_exists(spark, f"{state}/files/gen={n}/_SUCCESS")), default=0)


def _by_date(files: list[str]) -> dict[str | None, set[str]]:
    """Files per date; the date is in the name of their directory."""
    out: dict[str | None, set[str]] = {}
    for f in files:
        name = unquote(f.split("/", 1)[0].removeprefix(f"{DATE}="))
        out.setdefault(None if name == "__HIVE_DEFAULT_PARTITION__" else name, set()).add(f)
    return out


def _row_failures(rows: DataFrame, checks: list[Check]) -> DataFrame:
    at = [k for k, c in enumerate(checks) if c.kind != "unique"]
    if not at:
        return rows.sparkSession.createDataFrame([], _SCHEMAS["rows"])
    wide = rows.groupBy(DATE).agg(*[F.count_if(failing_condition(checks[k])).alias(f"c{k}") for k in at])
    each = F.array(*[F.struct(F.lit(k).alias("position"), F.col(f"c{k}").alias("failing")) for k in at])
    return wide.select(F.explode(each).alias("r"), DATE).select("r.*", DATE)


def _values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, bucket, h, value, ingestion_date) of every value that is not NULL."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    found = rows.select(F.explode(each).alias("v"), DATE).select("v.*", DATE).filter("value IS NOT NULL")
    h = F.xxhash64("value")
    return found.select("column", F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket"), h.alias("h"), "value", DATE)


def _repeats(spark: SparkSession, state: str, layer: DataFrame, columns: list[str], changed: DataFrame) -> DataFrame:
    """The values among the changed hashes that occur more than once."""
    # bounded: at most BUCKETS numbers; then the dates' names
    buckets = [r[0] for r in changed.select("bucket").distinct().collect()]
    values = _read(spark, state, "values").filter(F.col("bucket").isin(buckets))
    values = values.join(changed, ["column", "bucket", "h"], "left_semi")
    hot = values.groupBy("column", "bucket", "h").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    dates = [r[0] for r in values.join(hot, ["column", "bucket", "h"], "left_semi").select(DATE).distinct().collect()]
    if not dates:
        return spark.createDataFrame([], _SCHEMAS["repeats"])
    found = _values(in_dates(layer, dates), columns).join(hot, ["column", "bucket", "h"], "left_semi")
    return found.groupBy("column", "h", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def update_checks(spark: SparkSession, path: str, checks: list[Check] | None = None,
                  schema: StructType = SILVER_SCHEMA) -> list[str | None]:
    """Bring the summaries up to the layer's files (Parquet); returns the dates that were scanned or
    went. The first call scans all."""
    checks = SILVER_CHECKS if checks is None else checks
    columns = [c.column for c in checks if c.kind == "unique"]
    state = _folder(path, checks)
    now = _in_force(spark, state)
    files = data_files(spark, path)
    held = _by_date([r[0] for r in _read(spark, state, "files", now).collect()])    # names of files
    found = _by_date(files)
    dates = sorted((d for d in held.keys() | found.keys() if held.get(d) != found.get(d)), key=lambda d: d or "")
    if not dates and now:
        return []
    layer = read_layer(spark, path, schema) if files else spark.createDataFrame([], schema)
    scratch = scratch_path(spark, "checks")

    def staged(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    try:
        part = in_dates(layer, dates)
        rows = staged(_row_failures(part, checks), "rows")
        new = old = changed = None
        if columns:
            new = staged(_values(part, columns).groupBy("column", "bucket", "h", DATE).agg(F.count(F.lit(1)).alias("n")), "values")
            old = in_dates(_read(spark, state, "values"), dates)
            key = ["column", "bucket", "h"]
            changed = (new.select(*key, DATE, "n").unionByName(old.select(*key, DATE, (-F.col("n")).alias("n")))
                       .groupBy(*key, DATE).agg(F.sum("n").alias("n")).filter("n <> 0").select(*key))
            changed = changed.unionByName(_read(spark, state, "pending", now + 1)).distinct()
            changed = staged(changed, "changed")
            changed.write.mode("overwrite").parquet(f"{state}/pending/gen={now + 1}")
        # a date that went must be emptied; one that comes back is written whole
        for d in dates:
            if d not in found:
                for kind in ("rows", "values"):
                    remove_path(spark, f"{state}/{kind}/{partition_dir(DATE, d)}")
        overwrite_partitioned(rebalanced(rows, [DATE]), f"{state}/rows", [DATE], dynamic=True)
        if columns:
            laid = rebalanced(new, [DATE]).sortWithinPartitions(DATE, "bucket", "h")
            overwrite_partitioned(laid, f"{state}/values", [DATE], dynamic=True)
            kept = _read(spark, state, "repeats", now).join(changed, ["column", "h"], "left_anti")
            repeats = kept.unionByName(_repeats(spark, state, layer, columns, changed))
            repeats.write.mode("overwrite").parquet(f"{state}/repeats/gen={now + 1}")
        names = spark.createDataFrame([(f,) for f in files], _SCHEMAS["files"])
        names.coalesce(1).write.mode("overwrite").parquet(f"{state}/files/gen={now + 1}")
        for kind in ("files", "repeats", "pending"):
            remove_path(spark, f"{state}/{kind}/gen={now}")
        return dates
    finally:
        remove_path(spark, scratch)


def stored_report(spark: SparkSession, path: str, checks: list[Check] | None = None) -> DataFrame:
    """The report of ``operators.checks.run_checks`` from the summaries alone."""
    checks = SILVER_CHECKS if checks is None else checks
    state = _folder(path, checks)
    repeats = _read(spark, state, "repeats", _in_force(spark, state)).groupBy("column").agg(F.sum("n").alias("failing"))
    suite = spark.createDataFrame([(k, c.kind, c.column) for k, c in enumerate(checks)],
                                  "position int, check string, column string")
    unique = suite.filter("check = 'unique'").join(repeats, "column").select("position", "failing")
    failing = _read(spark, state, "rows").select("position", "failing").unionByName(unique)
    failing = failing.groupBy("position").agg(F.sum("failing").alias("failing"))
    report = suite.join(failing, "position", "left").orderBy("position")
    return report.select("check", "column", F.coalesce("failing", F.lit(0)).cast("long").alias("failing_rows"))
