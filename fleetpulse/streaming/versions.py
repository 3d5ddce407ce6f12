"""Output of a stream as one folder per micro-batch, and its compaction.

Every micro-batch writes ``<out>/_batch_id=N``, replaced if the batch is
retried. Compaction folds the committed folders below the newest into
``<out>/_merged/gen=K`` and then publishes them by creating one empty folder,
``<out>/_published/gen=K,upto=N``: readers take the highest generation and the
batch folders above its N. Before that folder exists they see the old state,
afterwards the new one, with the same rows; a crash in between leaves files
that nobody reads and that the next compaction replaces. Folders that a
generation replaced are deleted by the compaction after it, so a reader that
listed them just before can finish.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks import id_index
from ..sinks.writers import INGEST_KEY

BATCH_COL = "_batch_id"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _names(spark: SparkSession, path: str) -> list[str]:
    """Folder names under a path (a driver listing; compaction bounds it)."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    return [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    prefix = f"{BATCH_COL}="
    return sorted(int(n.removeprefix(prefix)) for n in _names(spark, path) if n.startswith(prefix))


def published(spark: SparkSession, out_path: str) -> tuple[int, int]:
    """(generation, highest batch id it holds) in force; (0, -1) for none."""
    found = [re.fullmatch(r"gen=(\d+),upto=(\d+)", n) for n in _names(spark, f"{out_path}/_published")]
    return max(((int(m[1]), int(m[2])) for m in found if m), default=(0, -1))


def write_batch(df: DataFrame, out_path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{out_path}/{BATCH_COL}={batch_id}")


def seen_before(spark: SparkSession, ids: DataFrame, out_path: str, batch_id: int) -> DataFrame:
    """The ``event_id`` of ``ids`` that earlier batches stored under
    ``out_path``, by an index of ids beside it (``sinks.id_index``): the batches
    since the last call are read, and the buckets that may hold one of the ids.
    A retried batch passes its own id, so it does not see its first attempt."""
    index = out_path.rstrip("/") + "_index"
    known = id_index.covered(spark, index)
    new = [i for i in range(batch_id) if str(i) not in known]

    def read_keys(units: list[str]) -> DataFrame:
        numbers = {int(u) for u in units}
        if min(numbers) <= published(spark, out_path)[1]:       # folded before it was indexed: read all
            rows = read_versions(spark, out_path, before=batch_id)
        else:
            paths = [f"{out_path}/{BATCH_COL}={i}" for i in batch_ids(spark, out_path) if i in numbers]
            rows = spark.read.schema("event_id string").parquet(*paths) if paths else None
        if rows is None:
            return spark.createDataFrame([], f"{INGEST_KEY} string")
        return rows.filter("event_id IS NOT NULL").select(F.col("event_id").alias(INGEST_KEY))

    id_index.cover(spark, index, [str(i) for i in new], read_keys)
    keys = ids.filter("event_id IS NOT NULL").select(F.col("event_id").alias(INGEST_KEY))
    return id_index.seen_keys(spark, keys, index).select(F.col(INGEST_KEY).alias("event_id"))


def read_versions(spark: SparkSession, out_path: str, before: int | None = None,
                  schema: str | None = None) -> DataFrame | None:
    """The rows of all batches (below ``before``) with ``_batch_id``; None
    where there is none yet. A retried batch passes its own id, so it reads
    what its first attempt read."""
    generation, upto = published(spark, out_path)
    ids = [i for i in batch_ids(spark, out_path) if i > upto and (before is None or i < before)]
    reader = lambda: spark.read.schema(schema) if schema else spark.read
    parts = []
    if generation:
        parts.append(reader().parquet(f"{out_path}/_merged/gen={generation}"))
    if ids:
        parts.append(reader().option("basePath", out_path)
                     .parquet(*[f"{out_path}/{BATCH_COL}={i}" for i in ids])
                     .withColumn(BATCH_COL, F.col(BATCH_COL).cast("long")))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def newest_per_key(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the highest batch id of every key (map-side top-1)."""
    w = Window.partitionBy(*keys).orderBy(F.col(BATCH_COL).desc())
    return versions.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def compact_versions(spark: SparkSession, out_path: str, merge: Callable[[DataFrame], DataFrame],
                     partition_by: tuple[str, ...] = (), schema: str | None = None) -> int | None:
    """Fold every committed batch below the newest into one generation and
    publish it. ``merge`` maps the rows with ``_batch_id`` to the merged rows
    (a ``_batch_id`` it leaves out is filled with the highest one). Returns the
    new generation, or None when there is nothing to do."""
    generation, upto = published(spark, out_path)
    older = [i for i in batch_ids(spark, out_path) if i > upto][:-1]
    if len(older) < 2:
        return None
    top = older[-1]
    merged = merge(read_versions(spark, out_path, before=top + 1, schema=schema))
    if BATCH_COL not in merged.columns:
        merged = merged.withColumn(BATCH_COL, F.lit(top).cast("long"))
    merged.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{out_path}/_merged/gen={generation + 1}")
    fs, marker = _fs(spark, f"{out_path}/_published/gen={generation + 1},upto={top}")
    if not fs.mkdirs(marker):
        raise OSError(f"could not publish {marker}")
    # what the generation before this one replaced
    for i in batch_ids(spark, out_path):
        if i <= upto:
            _delete(spark, f"{out_path}/{BATCH_COL}={i}")
    for name in _names(spark, f"{out_path}/_merged"):
        if int(name.removeprefix("gen=")) < generation:
            _delete(spark, f"{out_path}/_merged/{name}")
    return generation + 1


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if not fs.delete(p, True) and fs.exists(p):
        raise OSError(f"could not delete {path}")
