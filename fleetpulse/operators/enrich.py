"""Silver enrichment: event time parts, previous reading deltas, labels.

The previous reading per machine is the one operator whose natural form,
``lag() OVER (PARTITION BY equipment_id ORDER BY timestamp)``, does not scale:
a window partition is processed by one task, and a fleet of five machines
gives five tasks, one of which may hold a third of all rows. The default
strategy here range-partitions on (machine, time, id) instead, so a hot
machine is split over many tasks, computes the lag inside each partition with
Arrow, and patches the first row of every partition with the last row of the
partition before it (one row per partition, broadcast).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..sizing import partitions_for
from ..functions.columns import (
    day_of_week,
    emissions_severity,
    engine_status,
    hour_of_day,
    parse_event_time,
)

LAG_METRICS = ("rpm", "temp_coolant_c")
_PID = "_lag_pid"
_HEAD = "_lag_head"
_ROW = "_lag_row"


def add_time_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Replace the text event time by an instant (in place, NULL when the text
    does not parse) and add ``hour_of_day`` (0-23) and ``day_of_week``
    (1 = Sunday), both in UTC."""
    if dict(df.dtypes)[ts] == "string":
        df = df.withColumn(ts, parse_event_time(ts))
    return df.withColumns({"hour_of_day": hour_of_day(ts), "day_of_week": day_of_week(ts)})


def add_labels(df: DataFrame) -> DataFrame:
    """``emissions_severity`` and ``engine_status`` (first matching rule wins)."""
    return df.withColumns({"emissions_severity": emissions_severity(), "engine_status": engine_status()})


def _prev_name(c: str) -> str:
    return f"{c.removesuffix('_c')}_prev" if c == "temp_coolant_c" else f"{c}_prev"


def _delta_name(c: str) -> str:
    return f"{c.removesuffix('_c')}_delta" if c == "temp_coolant_c" else f"{c}_delta"


def _local_lag_fn(prev_names: Sequence[str]):
    """Arrow kernel over the key and the metrics of one range partition, batches in sorted
    order. Gives the in-partition previous values (NULL across a machine change) and
    marks the partition's first row for the cross-partition patch."""

    def same_key(a: pa.Array, b: pa.Array) -> pa.Array:
        eq = pc.fill_null(pc.equal(a, b), False)
        both_null = pc.and_(pc.is_null(a), pc.is_null(b))
        return pc.or_(eq, both_null)

    def shifted(arr: pa.Array, before: pa.Array) -> pa.Array:
        """arr[i-1] at position i, ``before`` (one value) at position 0."""
        return pa.concat_arrays([before, arr.slice(0, len(arr) - 1)])

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        carry: list[pa.Array] | None = None     # the last row of the previous batch
        for batch in batches:
            n = len(batch[0])
            head = np.zeros(n, dtype=bool)
            if n:
                if carry is None:
                    head[0] = True
                    carry = [pa.nulls(1, type=col.type) for col in batch]
                prevs = [shifted(col, last) for col, last in zip(batch, carry)]
                carry = [col.slice(n - 1, 1) for col in batch]
                same = same_key(batch[0], prevs[0])
                if head[0]:
                    same = pc.and_(same, pa.array(~head))
                cols = [pc.if_else(same, p, pa.nulls(n, type=p.type)) for p in prevs[1:]]
            else:
                cols = list(batch[1:])
            yield pa.StructArray.from_arrays([*cols, pa.array(head)], names=[*prev_names, _HEAD])

    return run


#: Above so many partitions the per-partition edge rows are joined by a shuffle
#: instead of being broadcast (an edge row is a few dozen bytes).
EDGE_BROADCAST_PARTITIONS = 100_000


def add_previous_values(df: DataFrame, key: str = "equipment_id",
                        order: Sequence[str] = ("timestamp", "event_id"),
                        metrics: Sequence[str] = LAG_METRICS,
                        num_partitions: int | None = None,
                        strategy: str = "range") -> DataFrame:
    """Add ``<metric>_prev`` = the metric of the previous row of the same key in
    ``order`` (NULL for a key's first row); NULL order values sort first.

    ``strategy="range"`` scales with rows, not with keys (see module
    docstring): one range shuffle; the two reads of it below are the same
    exchange, reused by the planner, so they see the same partition bounds.
    ``strategy="range_jvm"`` is the same operator with the in-partition step
    as a window keyed by range partition id instead of the Arrow kernel (no
    Python; one more shuffle and sort).
    ``strategy="window"`` is the plain window, one task per key; it is used
    only where the caller asks for it.
    """
    prev_names = [_prev_name(c) for c in metrics]
    if strategy == "window":
        w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        return df.withColumns({p: F.lag(c, 1).over(w) for c, p in zip(metrics, prev_names)})
    if strategy not in ("range", "range_jvm"):
        raise ValueError(f"unknown strategy {strategy!r}")

    spark = df.sparkSession
    if spark.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        # Both reads below must see one range partitioning; without exchange
        # reuse they would sample different bounds.
        raise ValueError("the range strategy needs spark.sql.exchange.reuse=true")
    jvm_local = strategy == "range_jvm"
    n = partitions_for(df, num_partitions)
    all_cols = list(df.columns)
    # The whole row travels through the shuffle as one struct, so both reads
    # of the shuffle below need exactly the same input (no reader can have
    # columns pruned or constants folded away), and the planner reuses the
    # exchange: both see the same partition bounds.
    packed = df.select(F.struct(*[F.col(c) for c in all_cols]).alias(_ROW))
    row = F.col(_ROW)
    sort_cols = [row.getField(key).asc_nulls_first()] + [row.getField(c).asc_nulls_first() for c in order]
    # Explicit partition count: AQE keeps it, so partition ids mean the same
    # thing to every reader of the shuffle.
    ranged = packed.repartitionByRange(n, *sort_cols)

    metric_types = {f.name: f.dataType for f in df.schema.fields}
    if jvm_local:
        # 1') previous value inside each range partition with a window keyed
        #     by the partition id: no Python, one more shuffle (by id) + sort.
        tagged = ranged.withColumn(_PID, F.spark_partition_id())
        w = Window.partitionBy(_PID).orderBy(*sort_cols)
        same = F.lag(row.getField(key), 1).over(w).eqNullSafe(row.getField(key))
        local = tagged.select(
            _ROW, _PID,
            *[F.when(same, F.lag(row.getField(c), 1).over(w)).alias(p) for c, p in zip(metrics, prev_names)],
            (F.row_number().over(w) == 1).alias(_HEAD))
    else:
        # 1) previous value inside each range partition (sorted, Arrow kernel): only the key
        #    and the metrics go to Python, the rows wait in the JVM. Not deterministic: the
        #    values hang on the order of the rows, so no rule may move it below the sort.
        tagged = ranged.sortWithinPartitions(*sort_cols).withColumn(_PID, F.spark_partition_id())
        out = StructType([StructField(p, metric_types[c], True) for c, p in zip(metrics, prev_names)]
                         + [StructField(_HEAD, BooleanType(), False)])
        lagged = F.arrow_udf(_local_lag_fn(prev_names), returnType=out).asNondeterministic()
        local = (tagged.withColumn("_l", lagged(row.getField(key), *[row.getField(c) for c in metrics]))
                 .select(_ROW, _PID, *[F.col("_l").getField(c).alias(c) for c in (*prev_names, _HEAD)]))

    # 2) first and last row of every partition, read from the same shuffle
    #    output without sorting it. mode(pid) is a typed aggregate: with it
    #    Spark plans an object hash aggregate (no sort) for the struct-valued
    #    min_by / max_by.
    order_struct = F.struct(*[row.getField(c).alias(c) for c in [key, *order]])
    edges = (ranged.withColumn(_PID, F.spark_partition_id())
             .groupBy(_PID)
             .agg(F.mode(F.col(_PID)).alias("_m"),
                  F.min_by(F.xxhash64(row), order_struct).alias("head_fp"),
                  F.max_by(F.struct(row.getField(key).alias("_k"), *[row.getField(c).alias(c) for c in metrics]),
                           order_struct).alias("t")))
    # last row of the nearest earlier non-empty partition (N rows, one task)
    prev_tail = (edges.withColumn("p", F.lag("t", 1).over(Window.orderBy(_PID)))
                 .select(F.col(_PID), "_m", "head_fp", "p"))

    # 3) patch the first row of each partition; prev_tail has one row per
    #    partition: it is broadcast while their number bounds its size, and
    #    joined by a shuffle beyond that.
    joined = local.join(F.broadcast(prev_tail) if n <= EDGE_BROADCAST_PARTITIONS else prev_tail, _PID, "left")
    # Guard: this partition's first row must be the one the edge read saw
    # (``_m`` is read here too, so the optimizer keeps the typed aggregate).
    diverged = F.col(_HEAD) & ((F.xxhash64(row) != F.col("head_fp")) | (F.col("_m") != F.col(_PID)))
    patch = F.col(_HEAD) & F.col("p").isNotNull() & F.col("p._k").eqNullSafe(row.getField(key))
    prevs = [F.when(diverged, F.raise_error(F.lit("range partitions diverged between reads")).cast(metric_types[c]))
             .when(patch, F.col(f"p.{c}")).otherwise(F.col(p)).alias(p)
             for c, p in zip(metrics, prev_names)]
    return joined.select(*[row.getField(c).alias(c) for c in all_cols], *prevs)


def add_prev_and_delta(df: DataFrame, key: str = "equipment_id",
                       order: Sequence[str] = ("timestamp", "event_id"),
                       metrics: Sequence[str] = LAG_METRICS,
                       num_partitions: int | None = None, strategy: str = "range") -> DataFrame:
    """``rpm_prev``, ``rpm_delta``, ``temp_coolant_prev``, ``temp_coolant_delta``
    (delta = current - previous, NULL on a machine's first reading), in the
    silver column order."""
    with_prev = add_previous_values(df, key, order, metrics, num_partitions, strategy)
    base = [c for c in df.columns]
    cols = [F.col(c) for c in base]
    for c in metrics:
        p = _prev_name(c)
        cols += [F.col(p), (F.col(c) - F.col(p)).alias(_delta_name(c))]
    return with_prev.select(*cols)


def enrich_readings(df: DataFrame, key: str = "equipment_id", num_partitions: int | None = None,
                    strategy: str = "range", transformed_at: bool = False) -> DataFrame:
    """All silver derived columns, in order: time parts, previous values and
    deltas, severity, status (and the transform stamp when asked)."""
    out = add_labels(add_prev_and_delta(add_time_parts(df), key=key,
                                        num_partitions=num_partitions, strategy=strategy))
    if transformed_at:
        out = out.withColumn("_transformed_at", F.current_timestamp())
    return out


__all__ = [
    "add_time_parts", "add_labels", "add_previous_values", "add_prev_and_delta", "enrich_readings",
]
