"""Gold from silver's change log: equal to a full build, without reading unchanged groups."""

import os
import random

import pytest
from conftest import reading, to_df
from fleetpulse.constants import GROUP_KEYS
from fleetpulse.operators.partials import apply_deltas, kpis_of_partials, partial_kpis
from fleetpulse.plans import changes, gold_deltas
from fleetpulse.plans import silver as silver_plan
from fleetpulse.plans.gold import build_gold
from fleetpulse.plans.silver import build_silver, transform_bronze_to_silver
from fleetpulse.session import scratch_path
from fleetpulse.sources.layers import BRONZE_SCHEMA, SILVER_SCHEMA, read_layer
from test_refresh import append, days, spoil


def paths(spark):
    return [scratch_path(spark, p) for p in ("bronze", "silver", "gold")]


def stored(spark, silver, gold):
    schema = build_gold(read_layer(spark, silver, SILVER_SCHEMA), updated_at=True).schema
    return read_layer(spark, gold, schema)


def table(df):
    return sorted(map(repr, df.select(*[c for c in sorted(df.columns) if c != "_updated_at"]).collect()))


def full(spark, bronze):
    return table(build_gold(build_silver(read_layer(spark, bronze, BRONZE_SCHEMA), with_lag=False)))


def refresh(spark, bronze, silver, day):
    transform_bronze_to_silver(spark, bronze, silver, dates=[f"2024-01-{day:02}"])


def test_deltas_of_random_rows_equal_their_aggregates(spark):
    rng = random.Random(4)
    odd = lambda v, n: rng.choice([None, float("nan"), 1e13, *[v] * n])
    metrics = ("rpm", "temp_coolant_c", "temp_oil_c", "pressure_oil_bar", "nox_ppm", "pm25_mg_m3")
    rows = [reading(event_id=f"e{k}", equipment_id=rng.choice(["EQ-1", None]), load_pct=odd(float(k), 200),
                    ingestion_date=f"2024-01-0{rng.randrange(1, 7)}", is_anomaly=rng.choice([True, False, None]),
                    **{m: odd(rng.randrange(100, 9900) / 10, 200) for m in metrics}) for k in range(120)]
    of = lambda part: partial_kpis(to_df(spark, part))
    before, deleted, inserted = rows[:90], rows[60:90], rows[90:]
    got = apply_deltas(of(before), of(inserted), of(deleted))
    key = lambda r: tuple(r[k] for k in GROUP_KEYS)
    want = {key(r): r.asDict() for r in kpis_of_partials(of(rows[:60] + inserted)).collect()}
    have = {key(r): r for r in kpis_of_partials(got, kept=("_again", "_changed")).collect()}
    assert set(have) == set(want)
    sure = [k for k, r in have.items() if not r._again]
    assert sure and len(sure) < len(want)
    for k in sure:
        assert {c: v for c, v in have[k].asDict().items() if c in want[k]} == want[k]


def test_gold_follows_late_moved_and_deleted_readings(spark):
    rng = random.Random(9)
    bronze, silver, gold = paths(spark)
    rows = days(rng, 5, n=10, broken=0)
    append(spark, rows, bronze, idempotent=False)
    transform_bronze_to_silver(spark, bronze, silver, changes=True)
    assert gold_deltas.update_gold(spark, silver, gold) == 1
    assert table(stored(spark, silver, gold)) == full(spark, bronze)
    assert gold_deltas.update_gold(spark, silver, gold) == 1        # nothing new
    # ids under another date with an earlier time: all of a machine's rows leave day 5, some extremes too
    moved = [{**r, "ingestion_date": "2024-01-02", "timestamp": "2024-01-01 00:00:00"} for r in rows if r["equipment_id"] != "EQ-1"]
    append(spark, moved, bronze, idempotent=False)
    refresh(spark, bronze, silver, 2)
    append(spark, days(rng, 7, late=2), bronze, idempotent=False)
    refresh(spark, bronze, silver, 7)
    assert gold_deltas.update_gold(spark, silver, gold) == 3        # two sets at once
    assert table(stored(spark, silver, gold)) == full(spark, bronze)
    # a date without rows any more goes
    append(spark, [{**r, "ingestion_date": "2024-01-03", "timestamp": "2023-12-01 00:00:00"} for r in rows], bronze, idempotent=False)
    refresh(spark, bronze, silver, 3)
    gold_deltas.update_gold(spark, silver, gold)
    assert table(stored(spark, silver, gold)) == full(spark, bronze)
    assert stored(spark, silver, gold).filter("ingestion_date = '2024-01-05'").isEmpty()
    changes.forget(spark, silver, 4)
    assert gold_deltas.update_gold(spark, silver, gold) == 4


def test_unchanged_groups_are_neither_read_nor_stamped(spark):
    bronze, silver, gold = paths(spark)
    mid = dict(rpm=1000.0)
    day1 = [reading(event_id="a", **mid)]
    day2 = [reading(event_id=f"{t}{k}", equipment_type=t, rpm=r, ingestion_date="2024-01-02", timestamp="2024-01-02 10:00:00")
            for t in ("excavator", "bulldozer") for k, r in enumerate((900.0, 1000.0, 1100.0))]
    append(spark, day1 + day2, bronze)
    transform_bronze_to_silver(spark, bronze, silver, changes=True)
    gold_deltas.update_gold(spark, silver, gold)
    stamps = {(r.ingestion_date, r.equipment_type): r._updated_at for r in stored(spark, silver, gold).collect()}
    append(spark, [reading(event_id="new", equipment_type="excavator", rpm=1300.0, ingestion_date="2024-01-02",
                           timestamp="2024-01-02 12:00:00")], bronze)
    refresh(spark, bronze, silver, 2)
    want = full(spark, bronze)
    spoil(silver, 1)
    for t in ("excavator", "bulldozer"):                # an insert needs no row of silver
        _spoil_type(silver, 2, t)
    gold_deltas.update_gold(spark, silver, gold)
    got = stored(spark, silver, gold)
    assert table(got) == want
    after = {(r.ingestion_date, r.equipment_type): r._updated_at for r in got.collect()}
    assert [k for k in after if after[k] != stamps[k]] == [("2024-01-02", "excavator")]


def _spoil_type(silver, day, kind):
    folder = f"{silver.removeprefix('file:')}/ingestion_date=2024-01-{day:02}/equipment_type={kind}"
    names = [n for n in os.listdir(folder) if n.startswith("part-")]
    assert names
    for n in names:
        crc = f"{folder}/.{n}.crc"
        if os.path.exists(crc):
            os.remove(crc)
        with open(f"{folder}/{n}", "r+b") as f:
            f.write(b"junk")
            f.seek(-4, 2)
            f.write(b"junk")


def test_an_update_that_dies_at_every_step_is_finished_once(spark, monkeypatch):
    rng = random.Random(6)
    bronze, silver, gold = paths(spark)
    append(spark, days(rng, 5, broken=0), bronze)
    transform_bronze_to_silver(spark, bronze, silver, changes=True)
    gold_deltas.update_gold(spark, silver, gold)
    append(spark, days(rng, 6, late=3, broken=0), bronze)
    refresh(spark, bronze, silver, 6)
    make = gold_deltas.make_folder
    for name, dies in (("overwrite_partitioned", lambda *a, **k: 1 / 0), ("write_clustered", lambda *a, **k: 1 / 0),
                       ("make_folder", lambda s, p: 1 / 0 if "_applied" in p else make(s, p))):
        with monkeypatch.context() as m:
            m.setattr(gold_deltas, name, dies)
            with pytest.raises(ZeroDivisionError):
                gold_deltas.update_gold(spark, silver, gold)
    append(spark, days(rng, 7, late=3, broken=0), bronze)
    refresh(spark, bronze, silver, 7)
    assert gold_deltas.update_gold(spark, silver, gold) == 3
    assert table(stored(spark, silver, gold)) == full(spark, bronze)


def test_a_refresh_that_died_has_its_groups_computed_anew(spark, monkeypatch):
    rng = random.Random(8)
    bronze, silver, gold = paths(spark)
    append(spark, days(rng, 5, broken=0), bronze)
    transform_bronze_to_silver(spark, bronze, silver, changes=True)
    gold_deltas.update_gold(spark, silver, gold)
    append(spark, days(rng, 6, broken=0), bronze)
    monkeypatch.setattr(silver_plan.change_log, "complete", lambda *a: 1 / 0)    # silver is written, the log is not ended
    with pytest.raises(ZeroDivisionError):
        refresh(spark, bronze, silver, 6)
    monkeypatch.undo()
    assert gold_deltas.update_gold(spark, silver, gold) == 1
    refresh(spark, bronze, silver, 6)
    assert changes.since(spark, silver + changes.BESIDE, 1)[2].filter("_sign <> 0").isEmpty()
    assert gold_deltas.update_gold(spark, silver, gold) == 2
    assert table(stored(spark, silver, gold)) == full(spark, bronze)
