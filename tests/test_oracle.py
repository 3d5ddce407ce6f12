"""Every registered engine query against its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from fleetpulse.oracle import ORACLE_SQL  # noqa: E402
from fleetpulse.queries import REGISTRY  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["cols_match"] and r["types_match"], r
    assert r["values_match"], r


def test_every_check_fails_somewhere(spark):
    rows = REGISTRY["data_checks_tampered"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 12 and all(r.failing_rows > 0 for r in rows), rows


def test_report_is_ordered_by_machine_then_day(spark):
    from pyspark.sql import functions as F

    from fleetpulse import queries as Q
    kpis = Q.daily_kpis(Q._silver_no_lag(spark, SF))
    want = [r[0] for r in kpis.orderBy(F.col("equipment_id").asc_nulls_first(), F.col("ingestion_date")).select("equipment_id").collect()]
    assert [r.equipment_id for r in REGISTRY["equipment_report"](spark, SF).collect()] == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
