"""Z-ordered tables: the same rows, and every column's filter skips files."""

import pytest
from conftest import reading, to_df
from fleetpulse.session import scratch_path
from fleetpulse.sinks.zorder import _rank, write_zordered, z_key
from pyspark.sql import functions as F


def candidates(df, column, value):
    """(files whose minimum and maximum allow the value, files that hold it, all files)."""
    files = df.groupBy(F.input_file_name().alias("file")).agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"), F.max(F.col(column) == F.lit(value)).alias("holds")).collect()
    may = [f for f in files if f.lo is not None and f.lo <= value <= f.hi]
    return len(may), sum(bool(f.holds) for f in files), len(files)


def test_a_filter_on_any_column_skips_files(spark):
    rows = [reading(event_id=f"e{m}-{t}-{h}", equipment_id=f"EQ-{m:03}", equipment_type=f"type-{t}", rpm=float(h))
            for m in range(16) for t in range(8) for h in range(16)]
    df = to_df(spark, rows).orderBy(F.xxhash64("event_id"))
    path = scratch_path(spark, "zorder")
    columns = {"equipment_id": "EQ-005", "equipment_type": "type-3", "rpm": 7.0}
    write_zordered(df, path, list(columns), num_partitions=64)
    back = spark.read.parquet(path)
    assert back.exceptAll(to_df(spark, rows)).isEmpty() and back.count() == len(rows)
    plain = scratch_path(spark, "plain")
    df.repartitionByRange(64, *columns).write.parquet(plain)
    for column, value in columns.items():
        may, holds, files = candidates(back, column, value)
        assert holds <= may <= files * 0.4, (column, may, files)
    # sorted by the columns one after the other, only the first helps
    assert candidates(spark.read.parquet(plain), "rpm", 7.0)[0] > 0.9 * 64


def test_nulls_empty_tables_and_too_many_bits(spark):
    rows = [reading(event_id=f"e{k}", equipment_id=None if k % 2 else "EQ", rpm=None) for k in range(6)]
    for part in (rows, []):
        path = scratch_path(spark, "zorder")
        write_zordered(to_df(spark, part), path, ["equipment_id", "rpm"], partition_by=("ingestion_date",), num_partitions=2)
        if part:
            assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        z_key(to_df(spark, rows), ["rpm"] * 11)


def test_ranks_count_the_bounds_below_and_are_computed_once(spark, capfd):
    values = [None, float("nan"), float("-inf"), -1.0, 0.0, 0.5, 1.0, 1.5, 2.0, 3.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for bounds in ([], [1.0], [0.0, 1.0, 1.0, 2.0], [0.0, 1.0, 2.0, float("nan")]):
        below = lambda v: sum(v is not None and (b < v or (v != v and b == b)) for b in bounds)
        assert [r[0] for r in df.select(_rank(F.col("x"), bounds)).collect()] == [below(v) for v in values]
    rows = spark.createDataFrame([(f"m{k}", float(k)) for k in range(100)], "m string, x double")
    z_key(rows, ["m", "x"]).explain()
    plan = capfd.readouterr().out
    assert plan.count("conv(") == 1 and "lambda" not in plan    # not for every bit and bound
