"""Day sketches: unions and differences against exact counts."""

from fleetpulse.operators import sketches as S
from fleetpulse.session import scratch_path
from pyspark.sql import functions as F


def readings(spark, n, first=0):
    """n events, 100 a machine, over ten days; every tenth event comes on two days."""
    rows = spark.range(first, first + n).select(
        F.concat(F.lit("E-"), "id").alias("event_id"),
        F.when(F.col("id") >= 100, F.concat(F.lit("M-"), F.floor(F.col("id") / 100))).alias("equipment_id"),
        F.format_string("2024-01-%02d", F.col("id") % 10 + 1).alias("ingestion_date"))
    return rows.unionByName(rows.filter("CAST(substring(event_id, 3) AS INT) % 100 = 0").withColumn("ingestion_date", F.lit("2024-01-07")))


def estimate(days, value, where="true"):
    return days.filter(where).agg(S.distinct(value).alias("n")).first()[0]


def test_unions_lie_within_the_error_in_any_order(spark):
    df = readings(spark, 60_000)
    days = S.day_sketches(df)
    half = "ingestion_date <= '2024-01-05'"
    for value in ("event_id", "equipment_id"):
        for where in ("true", half, "ingestion_date = '2024-01-07'"):
            part = df.filter(where)
            exact = part.select(value).distinct().count()
            assert abs(estimate(days, value, where) - exact) <= max(S.ERROR * exact, 0.5)
    assert estimate(days.repartition(7), "event_id") == estimate(days.orderBy(F.desc("ingestion_date")).coalesce(1), "event_id")


def test_differences(spark):
    old, new = readings(spark, 20_000), readings(spark, 20_000, 15_000).withColumn("ingestion_date", F.lit("2024-02-01"))
    days = S.day_sketches(old.unionByName(new))
    after = F.col("ingestion_date") == "2024-02-01"
    n = S.distinct_gone(days, "event_id", ~after, after).first()[0]
    assert abs(n - 15_000) <= S.ERROR * 20_000


def test_a_day_is_replaced_and_empty_tables(spark):
    path = scratch_path(spark, "sketches")
    S.store_sketches(readings(spark, 1000), path)
    read = lambda: spark.read.parquet(path)
    assert estimate(read(), "event_id") == 1000
    S.store_sketches(readings(spark, 50).withColumn("ingestion_date", F.lit("2024-01-07")), path)
    assert estimate(read(), "event_id", "ingestion_date = '2024-01-07'") == 50
    assert estimate(S.day_sketches(readings(spark, 0)), "event_id") == 0
