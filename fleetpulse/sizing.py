"""Partition counts of explicit-count shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame


def partitions_for(df: DataFrame, requested: int | None = None) -> int:
    """Partition count for an explicit-count shuffle, which AQE does not resize:
    the caller's, or ``spark.sql.shuffle.partitions`` (the one setting to raise
    with the data)."""
    return requested or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
