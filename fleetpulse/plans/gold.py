"""Silver -> gold as one lazy DataFrame plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.kpis import compact_view, daily_kpis, equipment_report, gold_view


def build_gold(silver: DataFrame, updated_at: bool = False) -> DataFrame:
    """The SQL model's gold table (36 columns with the stamp)."""
    return gold_view(daily_kpis(silver, updated_at=updated_at))


def build_gold_compact(silver: DataFrame) -> DataFrame:
    """The compact gold variant, with ``engine_issues``."""
    return compact_view(daily_kpis(silver))


def build_report(silver_or_kpis: DataFrame) -> DataFrame:
    kpis = silver_or_kpis if "total_readings" in silver_or_kpis.columns else daily_kpis(silver_or_kpis)
    return equipment_report(kpis)


def materialize_gold(spark, silver_path: str, gold_path: str, fmt: str = "parquet",
                     dates: list[str] | None = None, num_partitions: int | None = None) -> None:
    """Gold partitioned by ingestion date, rows clustered by machine and type
    inside every file. Gold groups include the date, so recomputing only
    ``dates`` (dynamic partition overwrite) is exact."""
    from pyspark.sql import functions as F

    from ..constants import GOLD_CLUSTER_BY, GOLD_PARTITIONS
    from ..sinks.writers import write_clustered
    from ..sources.layers import SILVER_SCHEMA, read_layer

    silver = read_layer(spark, silver_path, SILVER_SCHEMA, fmt)
    if dates is not None:
        silver = silver.filter(F.col("ingestion_date").isin(sorted(dates)))
    gold = build_gold(silver, updated_at=True)
    write_clustered(gold, gold_path, GOLD_PARTITIONS, GOLD_CLUSTER_BY, fmt, num_partitions,
                    dynamic=dates is not None)
