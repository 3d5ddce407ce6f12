"""The gold KPI model as Spark SQL over a named silver view, for teams that keep
models as SQL: the text is rendered from the measure table of
``operators.kpis`` and the score expressions of ``functions.columns``, so both
forms are one definition. The silver input is any table or view name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..constants import GROUP_KEYS
from ..functions.columns import anomaly_rate_sql, compliance_sql, health_sql
from ..operators.kpis import GOLD_MEASURES, MEASURES, measure_sql


def gold_kpis_sql_text(silver: str) -> str:
    keys = ", ".join(GROUP_KEYS)
    measures = ",\n    ".join(f"{measure_sql(kind, arg, places)} AS {name}" for name, kind, arg, places in MEASURES)
    return (f"WITH daily AS (\n  SELECT {keys},\n    {measures}\n  FROM {silver}\n  GROUP BY {keys}\n),\n"
            f"rated AS (SELECT *, {anomaly_rate_sql()} AS anomaly_rate_pct FROM daily)\n"
            f"SELECT {keys}, {', '.join(GOLD_MEASURES)},\n  {compliance_sql()} AS compliance_score,\n"
            f"  {health_sql()} AS equipment_health_status\nFROM rated")


def gold_kpis_sql(spark: SparkSession, silver: str | DataFrame, view: str = "silver_sensor_readings") -> DataFrame:
    """Run the SQL model on a table/view name, or on a DataFrame registered
    as a temporary view under ``view``."""
    if isinstance(silver, DataFrame):
        silver.createOrReplaceTempView(view)
        silver = view
    return spark.sql(gold_kpis_sql_text(silver))
