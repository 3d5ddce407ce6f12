"""Gold kept up to date from silver's change log, without computing groups anew.

Beside gold lie the partial aggregates of every group (``<gold>_partials``). An update adds
the partials of inserted rows and takes back those of deleted ones. Silver is read only for
groups where that is not enough (``operators.partials.apply_deltas``): a deleted row held an
extreme, a value is not in the exact sum, or the log knows no more than that
the group changed; and of silver only the directories of these groups. All other groups keep
their partials and their ``_updated_at``.

Changes must not be added twice, so an update has three steps that can each be repeated: the new
partials of the changed dates are staged under the number of the last set of changes they hold; both
tables' dates are replaced from there; the number is noted as applied. An
update that finds a staged one not yet noted finishes that first.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import GOLD_CLUSTER_BY, GOLD_PARTITIONS, GROUP_KEYS, SILVER_PARTITIONS
from ..operators.kpis import gold_view
from ..operators.partials import apply_deltas, kpis_of_partials, partial_kpis
from ..session import scratch_path
from ..sinks.writers import (
    folder_names,
    make_folder,
    overwrite_partitioned,
    path_exists,
    rebalanced,
    remove_path,
    write_clustered,
)
from ..sources.layers import SILVER_SCHEMA, read_layer
from . import changes
from .silver import in_dates, partition_dir


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(m[1]) for m in map(re.compile(r"upto=(\d+)").fullmatch, folder_names(spark, path)) if m)


def _exact_types(partials: DataFrame) -> DataFrame:
    """Sums at one decimal type, whether they come from rows, partials or storage."""
    return partials.withColumns({f.name: F.col(f.name).cast("decimal(38,6)") for f in partials.schema
                                 if f.name.startswith("exact_")})


def _from_rows(rows: DataFrame) -> DataFrame:
    return _exact_types(partial_kpis(rows)).withColumn("_updated_at", F.current_timestamp())


def _new_partials(spark: SparkSession, silver: DataFrame, stored: DataFrame, rows: DataFrame, scratch: str) -> DataFrame:
    """The partials of the changed dates; ``stored`` are those in force."""
    signed = [_from_rows(rows.filter(F.col("_sign") == s)) for s in (1, -1)]
    merged = apply_deltas(stored.drop("_updated_at"), *[p.drop("_updated_at") for p in signed])
    of = [F.col(k).alias(f"_{k}") for k in GROUP_KEYS]

    def same_group():
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in GROUP_KEYS])

    unknown = rows.filter("_sign = 0").select(*of).distinct()
    merged = _exact_types(merged).join(unknown.withColumn("_unknown", F.lit(True)), same_group(), "left")
    stamps = stored.select(*of, F.col("_updated_at").alias("_stamp"))
    merged = merged.drop(*[f"_{k}" for k in GROUP_KEYS]).join(stamps, same_group(), "left")
    merged = merged.withColumns({
        "_again": F.col("_again") | F.coalesce("_unknown", F.lit(False)),
        "_updated_at": F.when(F.col("_changed"), F.current_timestamp()).otherwise(F.col("_stamp"))})
    merged = merged.select(*stored.columns, "_again")
    merged.write.parquet(f"{scratch}/merged")
    merged = spark.read.schema(merged.schema).parquet(f"{scratch}/merged")
    again = merged.filter("_again").select(*of).unionByName(unknown).distinct()     # an unknown group may be new
    # the directories of these groups: names, not rows
    where = [tuple(r) for r in again.select(*[f"_{c}" for c in SILVER_PARTITIONS]).distinct().collect()]
    kept = merged.filter("NOT _again").drop("_again")
    if not where:
        return kept
    inside = reduce(or_, [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v).cast("string"))
                                                      for c, v in zip(SILVER_PARTITIONS, values)]) for values in where])
    anew = silver.filter(inside).join(again, same_group(), "left_semi")
    return kept.unionByName(_from_rows(anew))


def _stage(spark: SparkSession, silver: DataFrame, partials_path: str, staged: str, full: bool, rows: DataFrame) -> None:
    remove_path(spark, staged)      # of an attempt that did not end
    if full:
        _from_rows(silver).write.parquet(f"{staged}/partials")
        make_folder(spark, f"{staged}/_whole")
    else:
        scratch = scratch_path(spark, "gold-deltas")
        rows.write.parquet(f"{scratch}/rows")
        rows = spark.read.schema(changes.SCHEMA).parquet(f"{scratch}/rows")
        dates = rows.select("ingestion_date").distinct()
        dates.coalesce(1).write.parquet(f"{staged}/dates")
        schema = _from_rows(silver).schema
        stored = in_dates(read_layer(spark, partials_path, schema), [r[0] for r in dates.collect()])
        _new_partials(spark, silver, stored, rows, scratch).write.parquet(f"{staged}/partials")
        remove_path(spark, scratch)
    make_folder(spark, f"{staged}/_ready")


def _publish(spark: SparkSession, silver: DataFrame, partials_path: str, gold_path: str, fmt: str, staged: str,
             num_partitions: int | None) -> None:
    whole = path_exists(spark, f"{staged}/_whole")
    new = spark.read.schema(_from_rows(silver).schema).parquet(f"{staged}/partials")
    overwrite_partitioned(rebalanced(new, GOLD_PARTITIONS), partials_path, GOLD_PARTITIONS, dynamic=not whole)
    gold = gold_view(kpis_of_partials(new, kept=("_updated_at",)))
    write_clustered(gold, gold_path, GOLD_PARTITIONS, GOLD_CLUSTER_BY, fmt, num_partitions, dynamic=not whole)
    if not whole:       # dates that lost all their groups
        held = {r[0] for r in new.select("ingestion_date").distinct().collect()}
        for r in spark.read.schema("ingestion_date string").parquet(f"{staged}/dates").collect():
            if r[0] not in held:
                for path in (partials_path, gold_path):
                    remove_path(spark, f"{path}/{partition_dir('ingestion_date', r[0])}")


def update_gold(spark: SparkSession, silver_path: str, gold_path: str, fmt: str = "parquet",
                num_partitions: int | None = None) -> int:
    """Bring gold up to the last complete set of silver's change log; returns its number.
    Not to be run while silver is refreshed. The first call, and one after a full
    build of silver, computes all groups."""
    gold_path, log = gold_path.rstrip("/"), silver_path.rstrip("/") + changes.BESIDE
    partials_path, staging, applied = f"{gold_path}_partials", f"{gold_path}_staged", f"{gold_path}_applied"
    silver = read_layer(spark, silver_path, SILVER_SCHEMA, fmt)
    done = max(_numbers(spark, applied), default=0)

    def finish(number: int) -> int:
        _publish(spark, silver, partials_path, gold_path, fmt, f"{staging}/upto={number}", num_partitions)
        make_folder(spark, f"{applied}/upto={number}")
        remove_path(spark, f"{staging}/upto={number}")
        for n in _numbers(spark, applied):
            if n < number:
                remove_path(spark, f"{applied}/upto={n}")
        return number

    for n in _numbers(spark, staging):
        if n > done and path_exists(spark, f"{staging}/upto={n}/_ready"):
            done = finish(n)
    last, full, rows = changes.since(spark, log, done)
    if rows is None:
        return done
    _stage(spark, silver, partials_path, f"{staging}/upto={last}", full or not done, rows)
    return finish(last)
