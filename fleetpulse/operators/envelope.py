"""Per-type operating envelope check (readings vs expected metric ranges).

The envelope is a fixed dimension: one row per equipment type with a
(lo, hi) pair per metric -- five rows, so broadcasting it is safe whatever the
data size. Readings are joined to it once (no 9x unpivot of the big side);
the per-metric comparison happens in the join's projection, and only the
small aggregated result is unpivoted to one row per (type, metric).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ENVELOPE_COLUMNS, TYPE_ENVELOPES


def _values(rows: list[tuple], names: list[str]) -> str:
    """A SQL VALUES relation from fixed, trusted constants (JVM-side local
    relation with known size: no Python worker, no data-sized input)."""
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else f"CAST({float(v)!r} AS DOUBLE)"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM VALUES {body} AS t({', '.join(names)})"


def envelope_table(spark: SparkSession) -> DataFrame:
    """Wide envelope: equipment_type, <column>_lo, <column>_hi per metric."""
    names = ["equipment_type"]
    for col in ENVELOPE_COLUMNS.values():
        names += [f"{col}_lo", f"{col}_hi"]
    rows = []
    for etype, ranges in TYPE_ENVELOPES.items():
        row = [etype]
        for metric in ENVELOPE_COLUMNS:
            row += list(ranges[metric])
        rows.append(tuple(row))
    return spark.sql(_values(rows, names))


def envelope_long(spark: SparkSession) -> DataFrame:
    """Long form: (equipment_type, metric, lo, hi), 45 rows."""
    rows = [(t, c, *TYPE_ENVELOPES[t][m]) for t in TYPE_ENVELOPES for m, c in ENVELOPE_COLUMNS.items()]
    return spark.sql(_values(rows, ["equipment_type", "metric", "lo", "hi"]))


def with_envelope_violations(readings: DataFrame) -> DataFrame:
    """Add ``out_of_envelope``: the metrics outside their type's normal range
    (NULL for a type without an envelope, empty when all inside)."""
    env = envelope_table(readings.sparkSession)
    lo_hi = [c for c in env.columns if c != "equipment_type"]
    joined = readings.join(F.broadcast(env), "equipment_type", "left")
    items = [F.when((F.col(c) < F.col(f"{c}_lo")) | (F.col(c) > F.col(f"{c}_hi")), F.lit(c))
             for c in ENVELOPE_COLUMNS.values()]
    flagged = joined.withColumn(
        "out_of_envelope",
        F.when(F.col(f"{next(iter(ENVELOPE_COLUMNS.values()))}_lo").isNull(), F.lit(None))
         .otherwise(F.filter(F.array(*items), lambda x: x.isNotNull())))
    return flagged.drop(*lo_hi)


def envelope_summary(readings: DataFrame) -> DataFrame:
    """Per (equipment_type, metric): readings with a value, below, above the
    envelope. Types without an envelope are left out (inner join)."""
    env = envelope_table(readings.sparkSession)
    joined = readings.join(F.broadcast(env), "equipment_type", "inner")
    aggs = []
    for c in ENVELOPE_COLUMNS.values():
        aggs += [F.count(c).alias(f"{c}__n"),
                 F.count_if(F.col(c) < F.col(f"{c}_lo")).alias(f"{c}__below"),
                 F.count_if(F.col(c) > F.col(f"{c}_hi")).alias(f"{c}__above")]
    wide = joined.groupBy("equipment_type").agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"{c}__n").alias("readings"),
                              F.col(f"{c}__below").alias("below"), F.col(f"{c}__above").alias("above"))
                     for c in ENVELOPE_COLUMNS.values()])
    return wide.select("equipment_type", F.explode(rows).alias("r")).select("equipment_type", "r.*")
