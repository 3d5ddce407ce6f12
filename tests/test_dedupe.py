from conftest import reading, to_df
from fleetpulse.operators.dedupe import dedupe_events


def test_keep_first_by_time_then_payload(spark):
    rows = [reading(event_id="A", timestamp="2024-01-01 10:00:05", rpm=1.0),
            reading(event_id="A", timestamp="2024-01-01 10:00:01", rpm=2.0),
            reading(event_id="A", timestamp="2024-01-01 10:00:01", rpm=1.5),
            reading(event_id="B", rpm=7.0)]
    for parts in (1, 3):
        df = to_df(spark, rows).repartition(parts)
        got = {r.event_id: r.rpm for r in dedupe_events(df).collect()}
        assert got == {"A": 1.5, "B": 7.0}


def test_offsets_order_by_instant(spark):
    rows = [reading(event_id="A", timestamp="2024-01-01T10:00:00-03:00", rpm=1.0),   # 13:00 UTC
            reading(event_id="A", timestamp="2024-01-01T12:00:00+00:00", rpm=2.0)]
    assert dedupe_events(to_df(spark, rows)).first().rpm == 2.0


def test_map_side_group_limit_in_plan(spark):
    df = dedupe_events(to_df(spark, [reading(), reading()]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_collapses(spark):
    rows = [reading(event_id="HOT", rpm=float(i)) for i in range(500)] + [reading(event_id="x")]
    out = dedupe_events(to_df(spark, rows).repartition(8))
    got = {r.event_id: r.rpm for r in out.collect()}
    assert got["HOT"] == 0.0 and len(got) == 2
