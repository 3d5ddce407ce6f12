"""De-duplication in jobs: only rows whose key comes more than once are sorted and shipped."""

import pytest
from conftest import reading, to_df
from pyspark.sql import functions as F

from fleetpulse.operators import dedupe as D
from fleetpulse.plans import bronze as B
from fleetpulse.plans import silver as S
from fleetpulse.session import scratch_path
from fleetpulse.sinks import id_index as I
from fleetpulse.sinks.writers import INGEST_KEY, without_keys
from fleetpulse.streaming import daily_kpis as K


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def sorted_rows(monkeypatch):
    """How many rows each call of ``dedupe_events`` got from ``dedupe_stored``."""
    got, plain = [], D.dedupe_events
    monkeypatch.setattr(D, "dedupe_events", lambda df, *a, **k: got.append(df.count()) or plain(df, *a, **k))
    return got


def rows():
    return ([reading(event_id=f"E-{k}") for k in range(40)]
            + [reading(event_id=f"E-{k}", rpm=900.0, ingestion_date="2024-01-02") for k in range(3)]
            + [reading(event_id=None, rpm=r) for r in (1.0, 1.0, 2.0)])


@pytest.mark.parametrize("limit", [0, 2, 1000])
def test_the_rows_of_dedupe_events(spark, limit):
    df = to_df(spark, rows()).repartition(4)
    assert rows_of(D.dedupe_stored(df, limit=limit)) == rows_of(D.dedupe_events(df))


def test_a_first_ingest_sorts_only_repeated_and_id_less_rows(spark, sorted_rows):
    content = B.stamp_bronze(to_df(spark, [reading(event_id=None, rpm=2.0)]), F.lit("t"))
    like_a_key = content.select(B.ingest_key(content.columns)).first()[0]
    batch = B.stamp_bronze(to_df(spark, [*rows(), reading(event_id=like_a_key)]), F.lit("t"))
    new = B.prepare_bronze_batch(spark, batch, scratch_path(spark, "bronze"))
    plan = optimized(new)
    assert "LeftAnti" in plan and plan.index("Window ") < plan.index("LeftSemi")    # the join lies below the window
    assert sorted_rows == [10]      # three pairs, three without id and one whose id is a key
    assert rows_of(new.select("event_id", "rpm")) == rows_of(
        without_keys(batch, None).select("event_id", "rpm")) and new.count() == 42


def test_a_batch_like_the_store_is_joined_without_bloom_words(spark, tmp_dir):
    keys = lambda ids: spark.createDataFrame([(i,) for i in ids], f"{INGEST_KEY} string")
    I.cover(spark, f"{tmp_dir}/ids", ["u"], lambda _: keys([f"E-{k}" for k in range(100)]), keys_per_bucket=30)
    for ids, direct in ((range(90, 115), True), (range(90, 114), False)):
        read = {}
        got = I.seen_keys(spark, keys([f"E-{k}" for k in ids] * 2), f"{tmp_dir}/ids", read)
        assert rows_of(got) == rows_of(keys([f"E-{k}" for k in range(90, 100)]))
        assert (read["word_buckets"] == 0) == direct


def test_ranges_follow_the_rows(spark, monkeypatch):
    bronze, silver, asked = scratch_path(spark, "bronze"), scratch_path(spark, "silver"), []
    plain = S.build_silver
    monkeypatch.setattr(S, "build_silver", lambda *a, **k: asked.append(k["num_partitions"]) or plain(*a, **k))
    B.append_partitioned(B.stamp_bronze(to_df(spark, rows()), F.lit("t")), bronze, ["ingestion_date", "equipment_type"])
    S.transform_bronze_to_silver(spark, bronze, silver)
    monkeypatch.setattr(S, "ROWS_PER_RANGE", 20)
    S.transform_bronze_to_silver(spark, bronze, silver)
    monkeypatch.setattr(S, "ROWS_PER_RANGE", 1)
    S.transform_bronze_to_silver(spark, bronze, silver)
    S.transform_bronze_to_silver(spark, bronze, silver, num_partitions=5)
    assert asked == [1, 3, int(spark.conf.get("spark.sql.shuffle.partitions")), 5]


def test_streaming_kpis_sort_only_repeated_rows(spark, tmp_dir, sorted_rows):
    good = to_df(spark, [r for r in rows() if r["event_id"] is not None])
    good.coalesce(1).write.json(f"{tmp_dir}/src")
    good.filter("event_id < 'E-2'").coalesce(1).write.mode("append").json(f"{tmp_dir}/src")
    K.start_daily_kpis(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", max_files_per_trigger=1).awaitTermination()
    assert sorted_rows == [6, 4] or sorted_rows == [4, 6]
    kept = K.read_daily_kpis(spark, f"{tmp_dir}/out")
    assert kept.agg(F.sum("total_readings")).first()[0] == 40
