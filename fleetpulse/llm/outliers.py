"""Quality rules: robust multivariate outliers per language and source
(DataFrame functions only).

Every text gets exact counts (words, characters in words, symbols, repeated
lines, words in repeated 3-word windows, capitals). The base rule rejects texts
of fewer than ``MIN_WORDS`` words or with more than half of their words in
repeated windows. The others become a vector of four transformed statistics,
in thousandths: log of the mean word length, log(1 + 10 * symbols per word),
share of words in repeated windows, share of capitals. For each (language,
source) the minimum covariance determinant estimate of location and scatter is
approached by concentration steps from the coordinate-wise median and median
absolute deviation: a step takes the ``H_SHARE`` (half) of the vectors that lie
nearest by the last estimate and re-estimates from them; a reweighted estimate from everything
within the 97.5 % point follows. A text whose squared Mahalanobis distance is
above ``CUTOFF`` is rejected.

Vectors are integers, so sums over a subset are exact and reruns agree to the
last digit. "Nearest" is decided on distance buckets of 2 % width: whole
buckets are taken until they hold the share; a last bucket of more than
``BORDER`` of the group (copies of one text) counts with a weight, so that the
share is met. The scatter's diagonal gets
``FLOORS`` squared (a ridge): statistics that are constant in most texts would
otherwise have no spread, and any deviation would reject.

Scale: texts are read once, and what later steps need is staged (four numbers a
text). A step is one partial aggregation to (language, source, bucket), at most
2001 buckets a group, so a hot source is combined before the shuffle. The start's
medians are exact percentiles of integers (or halves) of at most about 15,000 values. Estimates
are one row a group, staged and broadcast only below Spark's threshold.

Defined results: NULL or empty text has zero words and fails the base rule;
NULL language or source is a group value of its own; a group of one text, or of
equal texts, keeps them (distance 0); repeated rows are judged alike; an empty
table gives an empty result. Input columns are carried in one struct, so their
names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CHARS, let, stage, words

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
CAPITALS = "".join(map(chr, [*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]))
H_SHARE = 0.5
#: A last bucket above this share of its group is weighted.
BORDER = 0.125
STEPS = 4
#: Standard deviations (thousandths) added to the scatter's diagonal.
FLOORS = (50.0, 100.0, 80.0, 15.0)
#: Chi-square points for four dimensions: 97.5 % for reweighting, 99.999 % to reject.
REWEIGHT = 11.143
CUTOFF = 28.47
#: share / P(chi-square with 6 degrees <= its 4-degree quantile): makes the
#: scatter of a trimmed normal sample consistent (for 50 % and for 97.5 %).
CONSISTENCY = {H_SHARE: 2.109, 0.975: 1.064}
_D = range(4)
_PAIRS = [(i, j) for i in _D for j in range(i + 1)]


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text."""
    def covered(grams: Column) -> Column:
        def repeated(g, k):
            return (F.coalesce(F.get(grams, k - 1)["g"] == g["g"], F.lit(False))
                    | F.coalesce(F.get(grams, k + 1)["g"] == g["g"], F.lit(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(
            F.filter(grams, repeated), lambda g: F.array(g["i"], g["i"] + 1, g["i"] + 2)))))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
        F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i")))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(F.sort_array(windows), covered))


def text_stats(text: Column) -> Column:
    """A struct of the exact counts of one text."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    per_words = let(words(text), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))
    return F.struct(
        per_words["n"].cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (chars - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        per_words["r"].cast("long").alias("n_repeat_words"),
        (chars - F.length(F.translate(text, CAPITALS, ""))).cast("long").alias("n_capitals"))


def _with_vector(df: DataFrame) -> DataFrame:
    """Adds base_failed and x0..x3 (NULL where the base rule fails)."""
    n, s = F.col("s.n_words"), "s."
    df = df.withColumn("base_failed", (n < MIN_WORDS) | (F.col(s + "n_repeat_words") * 100 > n * 50))
    x = [F.log(F.col(s + "word_chars") / n), F.log1p(F.col(s + "n_symbols") * 10 / n),
         F.col(s + "n_repeat_words") / n, F.col(s + "n_capitals") / F.col(s + "word_chars")]
    return df.withColumns({f"x{i}": F.when(~F.col("base_failed"), F.round(x[i] * 1000).cast("long")) for i in _D})


def _factor(est: DataFrame) -> DataFrame:
    """Columns c{i}{j} (scatter) become the Cholesky factor l{i}{j}."""
    for i, j in _PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        est = est.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    keep = ["g_lang", "g_source", *[f"m{i}" for i in _D], *[f"l{i}{j}" for i, j in _PAIRS]]
    return stage(est.select(*keep), "outlier-estimates")


def _with_estimate(rows: DataFrame, est: DataFrame) -> DataFrame:
    e = est.withColumnsRenamed({"g_lang": "e_lang", "g_source": "e_source"})
    return rows.join(e, F.col("g_lang").eqNullSafe(F.col("e_lang")) & F.col("g_source").eqNullSafe(F.col("e_source")),
                     "left").drop("e_lang", "e_source")


def _with_distance(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance by the group's estimate."""
    out = _with_estimate(rows, est)
    for i in _D:  # solve L y = x - m from the top
        y = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    out = out.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in _D), F.lit(0.0)))
    return out.drop(*est.columns[2:], *[f"y{i}" for i in _D])


def _estimate(rows: DataFrame, est: DataFrame, share: float | None) -> DataFrame:
    """Location and scatter of each group's nearest ``share`` (None: of all
    within the reweighting point) by the estimate ``est``."""
    bucket = F.least(F.floor(F.log1p("d2") * 50), F.lit(2000)).cast("int")
    near = _with_distance(rows, est)
    if share is None:
        near = near.filter(F.col("d2") <= REWEIGHT)
    sums = near.withColumn("bucket", bucket).groupBy("g_lang", "g_source", "bucket").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in _D],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS])
    if share is not None:
        group = Window.partitionBy("g_lang", "g_source")
        before = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = (sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
                .withColumn("all", F.sum("n").over(group))
                .filter(F.col("before") < F.col("all") * share))
        over = (F.col("before") + F.col("n") > F.col("all") * share) & (F.col("n") > F.col("all") * BORDER)
        sums = sums.withColumn("weight", F.when(over, (F.col("all") * share - F.col("before")) / F.col("n")))
    else:
        sums = sums.withColumn("weight", F.lit(None).cast("double"))
    # whole buckets as exact sums, plus the one bucket that has a weight
    total = lambda c: (F.coalesce(F.sum(F.when(F.col("weight").isNull(), F.col(c))), F.lit(0))
                       + F.coalesce(F.max(F.col("weight") * F.col(c)), F.lit(0.0))).alias(c)
    tot = sums.groupBy("g_lang", "g_source").agg(
        total("n"), *[total(f"s{i}") for i in _D], *[total(f"q{i}{j}") for i, j in _PAIRS])
    mean = {f"m{i}": F.col(f"s{i}") / F.col("n") for i in _D}
    c = CONSISTENCY[share or 0.975]
    cov = {f"c{i}{j}": (F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * c
           + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in _PAIRS}
    return _factor(tot.withColumns(mean).withColumns(cov))


def fit(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """One estimate per (g_lang, g_source) from the vectors x0..x3."""
    rows = rows.filter("NOT base_failed").select("g_lang", "g_source", *[f"x{i}" for i in _D])
    medians = stage(rows.groupBy("g_lang", "g_source").agg(
        *[F.percentile(f"x{i}", F.lit(0.5)).alias(f"m{i}") for i in _D]), "outlier-medians")
    est = _with_estimate(rows, medians).groupBy(*medians.columns).agg(
        *[F.percentile(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), F.lit(0.5)).alias(f"a{i}") for i in _D])
    est = _factor(est.withColumns({
        f"c{i}{j}": F.pow(F.col(f"a{i}") * 1.4826, F.lit(2)) + FLOORS[i] ** 2 if i == j else F.lit(0.0)
        for i, j in _PAIRS}))
    for _ in range(steps):
        est = _estimate(rows, est, H_SHARE)
    return _estimate(rows, est, None)


def judge(docs: DataFrame, carry: Column, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """``__d`` (the column or struct ``carry``), ``s`` (the counts),
    base_failed, distance (NULL where the base rule fails) and kept."""
    rows = docs.select(carry.alias("__d"), text_stats(F.col(text_col)).alias("s"),
                       F.col(lang_col).alias("g_lang"), F.col(source_col).alias("g_source"))
    rows = _with_vector(stage(rows, "outlier-stats"))
    scored = _with_distance(rows, fit(rows))
    return scored.select(
        "__d", "s", "base_failed", F.col("d2").alias("distance"),
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The input rows that are kept."""
    return judge(docs, F.struct("*"), **options).filter("kept").select("__d.*")
