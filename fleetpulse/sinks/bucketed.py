"""Catalog tables bucketed by the ingest key, so that work on ids needs no exchange.

A table is shuffled once, when it is written; joins on the key between two tables of
the same number of buckets, groupings and de-duplication by the key then read bucket by bucket.
The key is the id, or a hash of the content where there is none (``sinks.writers.ingest_key``), so rows without
an id are spread like others. ``unique`` keeps one row per key before the shuffle's
reducers see the copies: an id that is repeated a billion times is one row per map task.

Joins ask for a sort-merge join: a broadcast would need a size bound, and the buckets
are sorted already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedupe import dedupe_events
from ..sizing import partitions_for
from .writers import INGEST_KEY, ingest_key


def save_bucketed(df: DataFrame, name: str, buckets: int | None = None, unique: bool = False,
                  location: str | None = None, fmt: str = "parquet") -> int:
    """Write a table of one file per bucket, sorted by key inside; returns the number of buckets.
    ``spark.sql.shuffle.partitions`` unless given: tables to be joined need the same number."""
    n = buckets or partitions_for(df)
    keyed = df.withColumn(INGEST_KEY, ingest_key(df.columns))
    if unique:
        keyed = dedupe_events(keyed, key=INGEST_KEY)
    w = keyed.repartition(n, INGEST_KEY).write.format(fmt).mode("overwrite").bucketBy(n, INGEST_KEY).sortBy(INGEST_KEY)
    (w.option("path", location) if location else w).saveAsTable(name)
    return n


def unique_rows(spark: SparkSession, name: str) -> DataFrame:
    """One row per key (keep-first), bucket by bucket."""
    return dedupe_events(spark.table(name), key=INGEST_KEY)


def new_rows(spark: SparkSession, batch: str, stored: str) -> DataFrame:
    """One row per key of ``batch`` that ``stored`` does not have."""
    return unique_rows(spark, batch).join(spark.table(stored).select(INGEST_KEY).hint("merge"), INGEST_KEY, "left_anti")


def joined(spark: SparkSession, left: str, right: str, columns: list[str], how: str = "inner") -> DataFrame:
    """Rows of ``left`` with ``columns`` of ``right`` by key."""
    return spark.table(left).join(spark.table(right).select(INGEST_KEY, *columns).hint("merge"), INGEST_KEY, how)
