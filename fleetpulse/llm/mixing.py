"""Mixing sources to target weights (DataFrame functions only).

Sources are weighed in code point order (NULL last) by a repeating list of
weights. Together they share ``share`` times all tokens in proportion to their
weights, but no source gets more than ``max_rate`` times its own tokens; what a
capped source cannot take is shared again among the others by weight, until
none is above its cap. A source's repetition rate is target / tokens, and every
document is emitted floor(rate) times plus one Bernoulli copy with probability
equal to the fraction, drawn from a hash of seed and ``doc_id``: reruns agree.

Scale: one pass for the sizes, one partial aggregation per source (a hot source
is combined before the shuffle), and a window over one row per source, never
over documents. The staged source table is broadcast only if its file size is
below Spark's threshold.

Defined results: NULL text has size 0 (as has a text without words); a NULL
source is a source of its own, last in order; rows sharing a ``doc_id`` share
the draw; NULL ids draw as the empty id; sources without any word have target
0 and rate 0, so their documents are not emitted; an empty table gives an empty
mix. Other columns pass through; the copy number's column is ``mix_copy``
(underscores are appended while the name is taken).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_RATE = 2
SEED = 7


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 32 bits of md5(seed:doc_id)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    With the sources in order of cap / weight, the fill level after capping the
    first i of them is (total - their caps) / (all weights - their weights). It
    grows while capping is right and falls afterwards, so the level is its
    maximum and target = min(cap, level * weight)."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    per = stage(per, "mix-sources")
    # one row per source: windows without a partition are over sources only
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    per = (per.withColumn("rank", rank).withColumn("weight", weight)
           .withColumn("cap", F.col("source_size") * max_rate))
    everything = Window.partitionBy()
    before = (Window.orderBy((F.col("cap") / F.col("weight")), F.col("rank"))
              .rowsBetween(Window.unboundedPreceding, -1))
    level = ((F.sum("source_size").over(everything).cast("double") * share
              - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("double"))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return (per.withColumn("level", level)
            .withColumn("level", F.max("level").over(everything))
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")))


def mixing_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights=WEIGHTS, share: float = SHARE,
                max_rate: int = MAX_RATE, seed: int = SEED) -> DataFrame:
    """One row per document: ``__d`` (the whole input row as a struct), size,
    source_size, target and copies."""
    sized = docs.select(F.struct("*").alias("__d"))
    sized = sized.withColumn("size", n_words(F.col(f"__d.{text_col}")))
    targets = stage(source_targets(
        sized.select(F.col(f"__d.{source_col}").alias("source"), "size"), weights, share, max_rate), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sized.join(targets, F.col(f"__d.{source_col}").eqNullSafe(F.col("source")), "left")
    copies = F.floor("rate") + (uniform(F.col(f"__d.{id_col}"), seed)
                                < F.col("rate") - F.floor("rate")).cast("long")
    return (joined.withColumn("rate", rate).withColumn("copies", copies.cast("long"))
            .select("__d", "size", "source_size", "target", "copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every input row ``copies`` times, with ``mix_copy``
    numbering its copies from 1."""
    name = "mix_copy"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    plan = mixing_plan(docs, **options).filter("copies > 0")
    return (plan.select("__d", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__n"))
            .select("__d.*", F.col("__n").alias(name)))
