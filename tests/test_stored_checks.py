"""Stored check summaries: the report of a full scan, from the changed dates only."""

import random

import pytest
from conftest import reading, to_df
from fleetpulse.operators.checks import SILVER_CHECKS, Check, run_checks
from fleetpulse.operators.enrich import add_labels
from fleetpulse.plans import stored_checks
from fleetpulse.plans.stored_checks import stored_report, update_checks
from fleetpulse.session import scratch_path
from fleetpulse.sinks.writers import overwrite_partitioned, remove_path
from fleetpulse.sources.layers import read_layer
from test_refresh import spoil


def put(spark, path, rows):
    df = add_labels(to_df(spark, rows))
    overwrite_partitioned(df, path, ["ingestion_date"], dynamic=True)
    return df.schema


def report(df):
    return [tuple(r) for r in df.collect()]


def day(rng, d, n=12):
    odd = lambda v, bad: rng.choice([v, v, v, bad])
    return [reading(event_id=odd(f"e{rng.randrange(30)}", None), equipment_id=odd("EQ-001", rng.choice([None, "?"])),
                    nox_ppm=odd(100.0, rng.choice([None, -1.0, float("nan")])), temp_coolant_c=odd(90.0, 140.0),
                    ingestion_date=None if d is None else f"2024-01-{d:02}") for _ in range(n)]


@pytest.mark.parametrize("buckets", [1, 1024])
def test_reports_equal_a_full_scan(spark, monkeypatch, buckets):
    monkeypatch.setattr(stored_checks, "BUCKETS", buckets)
    rng = random.Random(buckets)
    path = scratch_path(spark, "layer")
    for days in ((1, 2, None), (2,), (3, 4, None), (1,), (4,)):
        schema = put(spark, path, [r for d in days for r in day(rng, d)])
        want = sorted((None if d is None else f"2024-01-{d:02}" for d in days), key=str)
        assert sorted(update_checks(spark, path, schema=schema), key=str) == want
        assert report(stored_report(spark, path)) == report(run_checks(read_layer(spark, path, schema)))
    assert update_checks(spark, path, schema=schema) == []
    remove_path(spark, f"{path}/ingestion_date=2024-01-03")
    assert update_checks(spark, path, schema=schema) == ["2024-01-03"]
    assert report(stored_report(spark, path)) == report(run_checks(read_layer(spark, path, schema)))


def test_unchanged_dates_are_not_read(spark):
    path = scratch_path(spark, "layer")
    rows = lambda d, *ids: [reading(event_id=i, ingestion_date=f"2024-01-{d:02}") for i in ids]
    schema = put(spark, path, rows(1, "a", "b") + rows(2, "c", "d", "d") + rows(3, "e"))
    update_checks(spark, path, schema=schema)
    put(spark, path, rows(3, "e", "f", "c"))
    want = report(run_checks(read_layer(spark, path, schema)))
    assert want[1] == ("unique", "event_id", 4)
    spoil(path, 1)          # of day 2 a changed value has a copy, so it is read
    assert update_checks(spark, path, schema=schema) == ["2024-01-03"]
    assert report(stored_report(spark, path)) == want
    spoil(path, 2)          # "d" stays a repeat without being read
    put(spark, path, rows(3, "e"))
    update_checks(spark, path, schema=schema)
    assert report(stored_report(spark, path))[1] == ("unique", "event_id", 2)


@pytest.mark.parametrize("dies", ["overwrite_partitioned", "_repeats", "values"])
def test_an_update_that_died_is_made_good(spark, monkeypatch, dies):
    rng = random.Random(5)
    path = scratch_path(spark, "layer")
    schema = put(spark, path, [r for d in (1, 2, 3) for r in day(rng, d)])
    update_checks(spark, path, schema=schema)
    put(spark, path, day(rng, 2))
    write = stored_checks.overwrite_partitioned
    boom = {"overwrite_partitioned": lambda *a, **k: 1 / 0, "_repeats": lambda *a, **k: 1 / 0,
            "values": lambda df, p, *a, **k: 1 / 0 if p.endswith("/values") else write(df, p, *a, **k)}[dies]
    with monkeypatch.context() as m:
        m.setattr(stored_checks, "overwrite_partitioned" if dies == "values" else dies, boom)
        with pytest.raises(ZeroDivisionError):
            update_checks(spark, path, schema=schema)
    if dies == "_repeats":      # the values of day 2 are new already, and day 3 changes before the next attempt
        put(spark, path, day(rng, 3))
    update_checks(spark, path, schema=schema)
    assert report(stored_report(spark, path)) == report(run_checks(read_layer(spark, path, schema)))


def test_suites_without_unique_or_rows_and_a_layer_without_files(spark):
    path = scratch_path(spark, "layer")
    schema = add_labels(to_df(spark, [reading()])).schema
    assert update_checks(spark, path, schema=schema) == []
    assert report(stored_report(spark, path)) == [(c.kind, c.column, 0) for c in SILVER_CHECKS]
    put(spark, path, [reading(event_id="a", equipment_id=None), reading(event_id="a", equipment_id=None)])
    for suite in ([Check("not_null", "equipment_id")], [Check("unique", "event_id"), Check("unique", "equipment_id")]):
        update_checks(spark, path, suite, schema)
        assert report(stored_report(spark, path, suite)) == report(run_checks(read_layer(spark, path, schema), suite))
