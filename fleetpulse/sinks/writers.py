"""Layer writers: partitioned append / overwrite, catalog tables, clustered
gold, idempotent append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe_events
from ..sizing import partitions_for

INGEST_KEY = "_ingest_key"


def _range_layout(df: DataFrame, partition_by: list[str], cluster_by: list[str],
                  num_partitions: int | None) -> DataFrame:
    """Range-partition on (partition columns, cluster columns) and sort inside
    each task: every output file holds one slice of one directory, sorted by
    the clustering keys. Unlike ``repartition(partition columns)`` a huge
    directory (one day with a third of all rows) is split over many tasks."""
    keys = [*partition_by, *cluster_by]
    if not keys:
        return df
    n = partitions_for(df, num_partitions)
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def rebalanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows hash-distributed by the partition columns; AQE splits a directory
    that is larger than its advisory size over several tasks and joins small
    ones, from the sizes it sees, without a sampling pass."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def append_partitioned(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet",
                       layout: bool = True) -> None:
    """Append into partition directories. With ``layout`` the rows are first
    ``rebalanced``, so each task writes a few directories instead of every task
    writing a file into every directory."""
    if layout:
        df = rebalanced(df, partition_by)
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def overwrite_partitioned(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet",
                          dynamic: bool = False) -> None:
    """Full overwrite (schema replaced), or with ``dynamic`` only the
    partitions present in ``df`` are replaced and all others survive."""
    w = df.write.format(fmt).mode("overwrite").partitionBy(*partition_by)
    w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if fmt == "delta":
        w = w.option("overwriteSchema", "true")
    w.save(path)


def save_as_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None, location: str | None = None) -> None:
    """Write a catalog table, in the warehouse or at ``location``."""
    w = df.write.format(fmt).mode(mode)
    if location:
        w = w.option("path", location)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_clustered(df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str],
                    fmt: str = "parquet", num_partitions: int | None = None, dynamic: bool = True) -> None:
    """Materialise a table partitioned by ``partition_by`` with rows
    clustered (sorted) by ``cluster_by`` inside every file."""
    laid = _range_layout(df, partition_by, cluster_by, num_partitions)
    overwrite_partitioned(laid, path, partition_by, fmt, dynamic=dynamic)


def ingest_key(columns: list[str], key: str = "event_id") -> Column:
    """Identity of a raw reading: its id, or for a reading without id a hash
    of its whole content (so exact re-sends of id-less rows also collapse)."""
    payload = F.to_json(F.struct(*[F.col(c) for c in columns if not c.startswith("_")]))
    return F.coalesce(F.col(key), F.concat(F.lit("#"), F.sha2(payload, 256)))


def stored_keys(existing: DataFrame, key: str = "event_id", columns: list[str] | None = None) -> DataFrame:
    """The ingest keys already stored, in two reads: rows with an id need only
    the id column; the content hash (all columns) is computed only for id-less
    rows, whose IS NULL filter lets Parquet skip row groups without NULL ids."""
    with_id = existing.filter(F.col(key).isNotNull()).select(F.col(key).alias(INGEST_KEY))
    no_id = existing.filter(F.col(key).isNull()).select(ingest_key(columns or existing.columns, key).alias(INGEST_KEY))
    return with_id.unionByName(no_id)


def new_rows_only(batch: DataFrame, existing: DataFrame | None, key: str = "event_id",
                  scope_column: str | None = None, scope_values: list | None = None) -> DataFrame:
    """Rows of ``batch`` to append so that re-running the same batch adds
    nothing: one row per ingest key inside the batch (keep-first), then a
    ``left_anti`` join against the keys already stored, under whatever date.
    Only where the caller knows that an id is never re-sent under another value
    of ``scope_column`` may ``scope_values`` limit the stored side (partition
    pruning; NULL is a value like any other)."""
    if existing is None:
        return without_keys(batch, None, key)
    cols = [c for c in batch.columns]
    if scope_column is not None and scope_values is not None:
        inside = F.col(scope_column).isin([v for v in scope_values if v is not None])
        if any(v is None for v in scope_values):
            inside = inside | F.col(scope_column).isNull()
        existing = existing.filter(inside)
    return without_keys(batch, stored_keys(existing, key, cols), key)


def without_keys(batch: DataFrame, stored: DataFrame | None, key: str = "event_id") -> DataFrame:
    """One row per ingest key of the batch (keep-first), without those stored."""
    deduped = dedupe_events(batch.withColumn(INGEST_KEY, ingest_key(batch.columns, key)), key=INGEST_KEY)
    if stored is not None:
        deduped = deduped.join(stored, INGEST_KEY, "left_anti")
    return deduped.drop(INGEST_KEY)


def only_keys(batch: DataFrame, keys: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per ingest key of the batch that is among ``keys`` (keep-first)."""
    keyed = batch.withColumn(INGEST_KEY, ingest_key(batch.columns, key)).join(keys, INGEST_KEY, "left_semi")
    return dedupe_events(keyed, key=INGEST_KEY).drop(INGEST_KEY)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staging folder this library created (recursive)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under a path; none where it does not exist."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(jpath) if st.isDirectory()] if fs.exists(jpath) else []


def make_folder(spark: SparkSession, path: str) -> None:
    """Create an empty folder, used as a marker that a step is done."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jpath):
        raise OSError(f"could not create {path}")
