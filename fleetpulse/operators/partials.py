"""Partial aggregates of the gold measures, and what is made of them.

Counts, sums, minima and maxima per gold key merge in any order; means, rates and scores are
derived from them with the batch layer's formulas. Counts and exact sums can also be
taken back: ``apply_deltas`` adds the partials of inserted rows and subtracts those of
deleted ones, and tells which groups have to be computed anew, because a deleted
row held their minimum or maximum, or because a value is not in the exact sum.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import GROUP_KEYS
from ..functions.columns import anomaly_rate_pct, compliance_score, health_status
from .enrich import add_labels
from .kpis import ENGINE_ISSUES, GOLD_MEASURES, GOLD_SCORES, MEASURES, exact_sum_sql, inexact_sql, mean_sql

_ALL = [*MEASURES, ENGINE_ISSUES]
_SUMMED = list(dict.fromkeys(arg for _, kind, arg, _ in _ALL if kind in ("avg", "sum")))


def partial_kpis(clean: DataFrame) -> DataFrame:
    """Partial aggregates per gold key: counts and extremes under their own
    names; per metric the exact sum, the double sum, the number of values and
    of values that the exact sum does not hold."""
    aggs = [F.expr(arg if kind == "count" else f"{kind.upper()}({arg})").alias(name)
            for name, kind, arg, _ in _ALL if kind in ("count", "max", "min")]
    for m in _SUMMED:
        aggs += [F.expr(exact_sum_sql(m)).alias(f"exact_{m}"), F.sum(m).alias(f"double_{m}"),
                 F.count(m).alias(f"n_{m}"), F.expr(inexact_sql(m)).alias(f"odd_{m}")]
    return add_labels(clean).groupBy(*GROUP_KEYS).agg(*aggs)


def merge_partials(parts: DataFrame) -> DataFrame:
    aggs = [{"count": F.sum, "max": F.max, "min": F.min}[kind](name).alias(name)
            for name, kind, _, _ in _ALL if kind in ("count", "max", "min")]
    for m in _SUMMED:
        aggs += [F.sum(f"exact_{m}").alias(f"exact_{m}"), F.sum(f"double_{m}").alias(f"double_{m}"),
                 F.sum(f"n_{m}").alias(f"n_{m}"), F.sum(f"odd_{m}").alias(f"odd_{m}")]
    return parts.groupBy(*GROUP_KEYS).agg(*aggs)


def kpis_of_partials(partials: DataFrame, kept: tuple[str, ...] = ()) -> DataFrame:
    """Gold keys, measures and scores, ``engine_issues``, and the columns ``kept``."""
    g, derived = partials, {}
    for name, kind, arg, places in _ALL:
        if kind == "count":
            derived[name] = F.col(name).cast("long")
        elif kind in ("max", "min"):
            derived[name] = F.round(F.col(name), places)
        else:
            exact = mean_sql(f"exact_{arg}", f"n_{arg}") if kind == "avg" else f"exact_{arg}"
            double = f"try_divide(double_{arg}, n_{arg})" if kind == "avg" else f"double_{arg}"
            derived[name] = F.expr(f"CASE WHEN odd_{arg} = 0 THEN CAST(ROUND({exact}, {places}) AS DOUBLE) "
                                   f"ELSE ROUND({double}, {places}) END")
    g = g.withColumns(derived).withColumn("anomaly_rate_pct", anomaly_rate_pct())
    g = g.withColumns({"compliance_score": compliance_score(),
                       "equipment_health_status": health_status("anomaly_rate_pct")})
    return g.select(*GROUP_KEYS, *GOLD_MEASURES, *GOLD_SCORES, "engine_issues", *kept)


_COUNTS = [name for name, kind, _, _ in _ALL if kind == "count"]
_EXTREMES = [(name, kind) for name, kind, _, _ in _ALL if kind in ("max", "min")]


def apply_deltas(stored: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """Stored partials with those of inserted rows added and those of deleted rows taken
    back. ``_changed`` tells the groups with any such row, ``_again`` those
    whose partials must be computed from their rows. Groups without rows are left out."""
    parts = (stored.withColumn("_role", F.lit(0)).unionByName(inserted.withColumn("_role", F.lit(1)))
             .unionByName(deleted.withColumn("_role", F.lit(-1))))
    role = F.col("_role")

    def signed(c: str) -> Column:
        return F.sum(F.when(role == -1, -F.col(c)).otherwise(F.col(c))).alias(c)

    def of(fn, c: str, r: int) -> Column:
        return fn(F.when(role == r, F.col(c)))

    aggs, again = [signed(c) for c in _COUNTS], []
    for name, kind in _EXTREMES:
        fn, reaches = (F.max, lambda a, b: a >= b) if kind == "max" else (F.min, lambda a, b: a <= b)
        aggs.append(fn(F.when(role >= 0, F.col(name))).alias(name))
        # a deleted row held it, and no inserted row reaches it
        again.append(F.coalesce(reaches(of(fn, name, -1), of(fn, name, 0)), F.lit(False))
                     & ~F.coalesce(reaches(of(fn, name, 1), of(fn, name, 0)), F.lit(False)))
    for m in _SUMMED:
        aggs += [signed(f"{what}_{m}") for what in ("exact", "double", "n", "odd")]
        again.append(F.max(F.col(f"odd_{m}") > 0))
    changed = F.max(role != 0).alias("_changed")
    out = parts.groupBy(*GROUP_KEYS).agg(*aggs, changed, reduce(or_, again).alias("_again")).filter("total_readings > 0")
    none_left = {f"{what}_{m}": F.when(F.col(f"n_{m}") > 0, F.col(f"{what}_{m}")) for m in _SUMMED for what in ("exact", "double")}
    return out.withColumns(none_left).withColumn("_again", F.col("_again") & F.col("_changed"))
