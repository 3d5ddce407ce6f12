"""Declarative data tests and layer summaries.

Each test returns its failing rows (empty means pass). ``run_checks`` counts
the failures of a whole suite in one pass: all row-level tests share a single
conditional aggregate over one scan; only uniqueness needs its own grouping
(partially aggregated before the shuffle).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    ACCEPTED_ENGINE_STATUSES,
    ACCEPTED_EQUIPMENT_IDS,
    ACCEPTED_EQUIPMENT_TYPES,
    ACCEPTED_SEVERITIES,
)


@dataclass(frozen=True)
class Check:
    kind: str                 # not_null | unique | accepted_values | expression_is_true
    column: str
    values: tuple = field(default=())
    expression: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def failing_condition(check: Check) -> Column:
    """Row-level failure predicate (two-valued: NULL never counts as failing,
    except for not_null)."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return F.coalesce(~c.isin(list(check.values)), F.lit(False))
    if check.kind == "expression_is_true":
        return F.coalesce(~F.expr(f"`{check.column}` {check.expression}"), F.lit(False))
    raise ValueError(f"no row-level predicate for {check.kind}")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(failing_condition(Check("not_null", column)))


def check_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(failing_condition(Check("accepted_values", column, tuple(values))))


def check_expression(df: DataFrame, column: str, expression: str) -> DataFrame:
    """Rows where ``<column> <expression>`` is false (e.g. ``">= 0"``)."""
    return df.filter(failing_condition(Check("expression_is_true", column, expression=expression)))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (NULL excluded), with their count."""
    return (df.filter(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


# The twelve tests declared on the silver layer.
SILVER_CHECKS: list[Check] = [
    Check("not_null", "event_id"),
    Check("unique", "event_id"),
    Check("not_null", "equipment_id"),
    Check("accepted_values", "equipment_id", tuple(ACCEPTED_EQUIPMENT_IDS)),
    Check("not_null", "equipment_type"),
    Check("accepted_values", "equipment_type", tuple(ACCEPTED_EQUIPMENT_TYPES)),
    Check("not_null", "nox_ppm"),
    Check("expression_is_true", "nox_ppm", expression=">= 0"),
    Check("not_null", "temp_coolant_c"),
    Check("expression_is_true", "temp_coolant_c", expression="between 50 and 130"),
    Check("accepted_values", "emissions_severity", tuple(ACCEPTED_SEVERITIES)),
    Check("accepted_values", "engine_status", tuple(ACCEPTED_ENGINE_STATUSES)),
]


def run_checks(df: DataFrame, checks: list[Check] | None = None) -> DataFrame:
    """Report ``(check, column, failing_rows)`` for a suite, in suite order.
    For ``unique`` the count is the number of rows whose value repeats."""
    checks = SILVER_CHECKS if checks is None else checks
    row_checks = [(i, c) for i, c in enumerate(checks) if c.kind != "unique"]
    parts: list[DataFrame] = []
    if row_checks:
        wide = df.agg(*[F.count_if(failing_condition(c)).alias(f"c{i}") for i, c in row_checks])
        stacked = wide.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("pos"), F.lit(c.kind).alias("check"), F.lit(c.column).alias("column"),
                     F.col(f"c{i}").alias("failing_rows"))
            for i, c in row_checks])).alias("r")).select("r.*")
        parts.append(stacked)
    for i, c in enumerate(checks):
        if c.kind == "unique":
            dup = check_unique(df, c.column).agg(F.coalesce(F.sum("n_records"), F.lit(0)).cast("long")
                                                 .alias("failing_rows"))
            parts.append(dup.select(F.lit(i).alias("pos"), F.lit(c.kind).alias("check"),
                                    F.lit(c.column).alias("column"), "failing_rows"))
    report = reduce(DataFrame.unionByName, parts)
    return report.orderBy("pos").drop("pos")


def bronze_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row: total_records, null_event_id, null_equipment_id,
    distinct_equipment (NULL counted as a value, like DISTINCT), anomaly_records.
    ``approx`` swaps the exact distinct count (one extra shuffle of the
    distinct ids) for a HyperLogLog sketch merged map-side."""
    distinct = F.approx_count_distinct("equipment_id") if approx else F.count_distinct("equipment_id")
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("event_id").isNull()).alias("null_event_id"),
        F.count_if(F.col("equipment_id").isNull()).alias("null_equipment_id"),
        (distinct + F.max(F.col("equipment_id").isNull().cast("int"))).alias("distinct_equipment"),
        F.count_if(F.col("is_anomaly")).alias("anomaly_records"),
    ).withColumn("distinct_equipment", F.coalesce(F.col("distinct_equipment"), F.lit(0)).cast("long"))


def row_count(df: DataFrame) -> DataFrame:
    """Global row count as a one-row DataFrame (column ``rows``)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))
