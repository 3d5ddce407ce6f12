"""Line dedup by site-relative frequency (DataFrame functions only).

A line is boilerplate on a host if it stands on more than ``ratio`` of the
host's pages and on at least ``min_pages`` of them. Boilerplate lines are
dropped from the host's pages; all other lines keep their order. Lines compare
without white space at their ends; lines without a word are never boilerplate.

Pages of a host with the same text count as one page, in the numerator and in
the host's total: a text that was copied many times is no template, and its
lines must not vanish from all its copies.

Scale: each page contributes each of its lines once (deduplicated inside the
row); the counts are two partial aggregations keyed by (host, line hash, page
hash), so neither a hot host nor a hot line lands in one task. A host has at
most (mean distinct lines per page) / ratio boilerplate lines, which bounds the
array joined to its pages; the staged host table is broadcast only below
Spark's threshold. A line is told from another by a 64-bit hash: a line can be
dropped wrongly only if it collides with one of its own host's few boilerplate
lines.

Defined results: NULL text stays NULL with no lines; NULL host is a host of its
own; a page of boilerplate only becomes empty; repeated rows are one page but
each is cleaned; an empty table gives an empty result. Other columns pass
through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, stage

RATIO = 0.1
MIN_PAGES = 5


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(SPACE_CHARS)))


def boilerplate_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                      ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the hashes of each host's boilerplate lines."""
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    keyed = pages.select("host", F.xxhash64("text").alias("page"), F.split("text", "\n").alias("lines"))
    totals = stage(keyed.groupBy("host").agg(F.count_distinct("page").alias("n_pages")), "line-hosts")
    blank = F.lit("")
    lines = keyed.select("host", "page", F.explode(F.array_distinct(F.transform(
        F.filter("lines", lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != blank), _key))).alias("line"))
    counts = (lines.groupBy("host", "line").agg(F.count_distinct("page").alias("n"))
              .filter(F.col("n") >= min_pages))
    t = totals.withColumnRenamed("host", "t_host")
    frequent = (counts.join(t, F.col("host").eqNullSafe(F.col("t_host")))
                .filter(F.col("n") > F.lit(ratio) * F.col("n_pages")))
    return frequent.groupBy("host").agg(F.collect_list("line").alias("lines"))


def clean_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per input row: ``__d`` (the input row as a struct), n_lines,
    n_dropped and ``clean`` (the text without boilerplate lines)."""
    bad = stage(boilerplate_lines(docs, host_col, text_col, ratio, min_pages), "line-boilerplate")
    bad = bad.select(F.col("host").alias("__host"), F.col("lines").alias("__bad"))
    rows = docs.select(F.struct("*").alias("__d"))
    text = F.col(f"__d.{text_col}")
    rows = rows.join(bad, F.col(f"__d.{host_col}").eqNullSafe(F.col("__host")), "left")
    rows = rows.withColumn("__lines", F.coalesce(F.split(text, "\n"), F.array().cast("array<string>")))
    rows = rows.withColumn("__keep", F.when(F.col("__bad").isNull(), F.col("__lines")).otherwise(
        F.filter("__lines", lambda x: ~F.array_contains(F.col("__bad"), _key(x))
                 | (F.btrim(x, F.lit(SPACE_CHARS)) == ""))))
    return rows.select(
        "__d", F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__keep")).cast("long").alias("n_dropped"),
        F.when(text.isNull(), text).otherwise(F.array_join("__keep", "\n")).alias("clean"))


def drop_boilerplate(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The input rows with boilerplate lines removed from the text."""
    rows = clean_lines(docs, text_col=text_col, **options)
    return rows.select(*[(F.col("clean") if c == text_col else F.col(f"__d.`{c}`")).alias(c) for c in docs.columns])
