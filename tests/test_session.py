"""Session options: defaults, table formats, the caller's; and what the library does without the corpus operators."""

import os
import subprocess
import sys

from fleetpulse.session import DEFAULT_CONF, session_options

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_options_of_a_table_format_and_the_callers():
    assert session_options() == DEFAULT_CONF
    got = session_options("delta", {"spark.sql.extensions": "a.B,c.D", "spark.sql.session.timeZone": "Asia/Tokyo", "x": 1})
    assert got["spark.sql.extensions"] == "io.delta.sql.DeltaSparkSessionExtension,a.B,c.D"
    assert got["spark.sql.catalog.spark_catalog"].endswith("DeltaCatalog")
    assert got["spark.sql.session.timeZone"] == "Asia/Tokyo" and got["x"] == "1"
    assert "spark.sql.extensions" not in session_options("parquet", {"x": 1})
    assert session_options("iceberg")["spark.sql.extensions"].startswith("org.apache.iceberg")


def test_a_session_gets_them():
    code = """
from fleetpulse.session import local_session
spark = local_session(2, extra={"spark.sql.extensions": "not.on.the.ClassPath", "spark.sql.shuffle.partitions": 3})
assert spark.conf.get("spark.sql.extensions") == "not.on.the.ClassPath"
assert spark.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("spark.sql.session.timeZone") == "UTC"
assert spark.range(5).groupBy("id").count().count() == 5
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_the_entry_works_without_the_corpus_operators():
    code = """
import sys
sys.modules["fleetpulse.llm"] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert names and not any(n.startswith("op") and n[2:3].isdigit() or n == "pipeline" for n in names)
assert set(entry.oracle_sql()) <= names
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=60)
