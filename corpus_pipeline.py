"""The corpus pipeline: ``documents`` through the corpus operators.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read back as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm import decontam, forest_join, line_dedup, mixing, outliers
from fleetpulse.llm.common import read_table, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """1: documents that the quality rules reject go."""
    return outliers.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """9: site boilerplate lines go from the texts."""
    return line_dedup.drop_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """7: one document of every group of near copies stays."""
    return forest_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """10: documents that hold passages of the benchmark go."""
    return decontam.drop_leaked(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """8: every document as often as its source's target asks."""
    return mixing.mix(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontaminate), ("mixing", mixture)]

#: Estimates by repeated concentration steps and signature tries have no SQL
#: form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
