"""Quality rules, line dedup and mixing against plain-Python forms."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import line_dedup, mixing, outliers

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, host string, size int, s string"
rng = random.Random(4)
WORDS = [f"w{k}" for k in range(400)]


def prose(n, r=rng):
    return " ".join(r.choice(WORDS) for _ in range(n))


def row(i, text, lang="en", source="a"):
    return (i, text, lang, source, "clash", "clash", -1, "clash")


@pytest.fixture(scope="module")
def docs():
    rows = [row(k, prose(60 + k % 50), "en" if k % 3 else "de", "ab"[k % 2]) for k in range(160)]
    rows += [row(200, None), row(201, ""), row(202, " \t\n\n "), row(203, "x " * 30000),
             row(204, "a b c a b c\na b c\n\na b c"), row(None, prose(70)), row(205, prose(70), None, None),
             row(206, "#$%& " * 200, "en", "a"), row(207, "# \n".join(prose(9) for _ in range(12))),
             row(3, rows[3][1]), row(3, rows[3][1]), row(208, "é " * 80 + " x"), row(209, "a b c d")]
    return rows


def counts(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    seen = defaultdict(list)
    for k in range(len(w) - 2):
        seen[tuple(w[k:k + 3])].append(k)
    covered = {j for at in seen.values() if len(at) > 1 for k in at for j in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_base_counts(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA).select("doc_id", "text", outliers.text_stats(F.col("text")).alias("q"))
    for r in df.collect():
        assert (r.q.n_words, r.q.word_chars, r.q.n_symbols, r.q.n_dup_lines, r.q.n_repeat_words) == counts(r.text)


def vector(text):
    n, chars, symbols, _, repeated = counts(text)
    capitals = sum(c in outliers.CAPITALS for c in text)
    x = [math.log(chars / n), math.log1p(symbols * 10 / n), repeated / n, capitals / chars]
    return [math.floor(v * 1000 + 0.5) for v in x]


def concentrate(x):
    """The documented steps with numpy on one group."""
    floors = np.diag(np.square(outliers.FLOORS))
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    mean, cov = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2) + floors

    def distance():
        d = x - mean
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)

    for share in [outliers.H_SHARE] * outliers.STEPS + [None]:
        d2 = distance()
        if share is None:
            near = d2 <= outliers.REWEIGHT
        else:
            bucket = np.minimum(np.floor(np.log1p(d2) * 50), 2000)
            before = np.array([(bucket < b).sum() for b in bucket])
            near = before < len(x) * share
        sub = x[near]
        mean = sub.mean(0)
        cov = (sub.T @ sub / len(sub) - np.outer(mean, mean)) * outliers.CONSISTENCY[share or 0.975] + floors
    return distance()


def test_outliers_match_concentration_steps(spark, docs):
    got = outliers.judge(spark.createDataFrame(docs, SCHEMA), F.struct("*")).collect()
    assert len(got) == len(docs)
    groups = defaultdict(list)
    for r in got:
        n, _, _, _, repeated = counts(r["__d"].text)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        if r.base_failed:
            assert not r.kept and r.distance is None
        else:
            groups[r["__d"].lang, r["__d"].source].append(r)
    assert (None, None) in groups
    for rows in groups.values():
        d2 = concentrate(np.array([vector(r["__d"].text) for r in rows], float))
        assert np.allclose([r.distance for r in rows], d2, rtol=1e-6, atol=1e-6)
        assert [r.kept for r in rows] == (d2 <= outliers.CUTOFF).tolist()
    by_id = {r["__d"].doc_id: r.kept for r in got}
    assert by_id[205] and by_id[0] and not by_id[206] and not by_id[200] and not by_id[203]


@pytest.mark.parametrize("junk", ["copies", "one statistic", "varied"])
def test_a_third_of_junk_is_rejected(spark, junk):
    r = np.random.default_rng(7)
    n, m, sd = 900, 306, np.array([60.0, 150.0, 30.0, 8.0])
    x = r.normal(0, 1, (n, 4)) * sd
    if junk == "copies":
        x[:m] = r.uniform(7, 46, 4) * sd
    elif junk == "one statistic":
        x[:m] = [0, 30 * math.hypot(sd[1], outliers.FLOORS[1]), 0, 0]
    else:
        x[:m] = r.uniform(7, 46, (m, 4)) * sd
    rows = [("en", "a", False, k < m, *map(int, np.round(v))) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g_lang string, g_source string, base_failed boolean, junk boolean, x0 long, x1 long, x2 long, x3 long")
    out = outliers._with_distance(df, outliers.fit(df)).filter(F.col("d2") <= outliers.CUTOFF).groupBy("junk").count().collect()
    assert {x.junk: x["count"] for x in out} == {False: n - m}


def test_keep_good_returns_the_input_columns(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA)
    kept = outliers.keep_good(df)
    assert kept.columns == df.columns
    assert sum(r.doc_id == 3 for r in kept.collect()) == 3
    assert outliers.keep_good(df.limit(0)).count() == 0


# --- line dedup ------------------------------------------------------------

def plain_lines(rows, ratio, min_pages):
    pages, seen = defaultdict(set), defaultdict(set)
    trim = lambda s: s.strip(" \t\n\x0b\x0c\r")
    for _, text, _, host, *_ in rows:
        if text is not None:
            pages[host].add(text)
            for x in text.split("\n"):
                seen[host, trim(x)].add(text)
    out = []
    for i, text, _, host, *_ in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        keep = [x for x in lines if not trim(x) or not (
            len(seen[host, trim(x)]) >= min_pages and len(seen[host, trim(x)]) > ratio * len(pages[host]))]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=repr)


def test_line_dedup(spark):
    r = random.Random(9)
    rows = []
    for k in range(120):
        lines = [prose(6, r) for _ in range(r.randint(0, 5))]
        host = r.choice(["h1", "h1", "h2", None, "tiny"]) if k > 5 else "tiny2"
        if host != "h2" and r.random() < 0.5:
            lines.insert(0, " menu \t")
        if r.random() < 0.05:
            lines += ["rare note", "", "  "]
        rows.append(row(k, "\n".join(lines), source=host))
    copied = "only\nboilerplate like\ntext"
    rows += [row(500 + k, copied, source="h2") for k in range(60)] + [row(600, None, source="h2"), row(601, "menu", source="h1")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((x["__d"].doc_id, x.clean, x.n_lines, x.n_dropped) for x in line_dedup.clean_lines(df).collect()), key=repr)
    assert got == plain_lines(rows, line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert any(d for *_, d in got)
    texts = {x.doc_id: x.text for x in line_dedup.drop_boilerplate(df).collect()}
    assert texts[500] == copied and texts[601] == "" and texts[600] is None
    assert line_dedup.drop_boilerplate(df).columns == df.columns
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


# --- mixing ----------------------------------------------------------------

def fill(sizes, share=mixing.SHARE, cap=mixing.MAX_RATE):
    """Round by round: excess above the caps is shared again by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % len(mixing.WEIGHTS)] for k, s in enumerate(order)}
    left, target, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if cap * sizes[s] <= level * weight[s]]
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mixing(spark):
    r = random.Random(2)
    rows = [row(k, prose(r.randint(0, 40), r), source=r.choice(["a", "a", "a", "b", "ä", "Z", None])) for k in range(900)]
    rows += [row(1000, None, source="nothing"), row(None, "one two", source="a"), row(7, rows[7][1], source=rows[7][3])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixing_plan(df).collect()
    sizes = Counter()
    for _, text, _, source, *_ in rows:
        sizes[source] += len((text or "").split())
    want = fill(sizes)
    taken = Counter()
    for x in got:
        source = x["__d"].source
        assert x.size == len((x["__d"].text or "").split()) and x.source_size == sizes[source]
        assert math.isclose(x.target, want[source], rel_tol=1e-9, abs_tol=1e-9)
        rate = want[source] / sizes[source] if sizes[source] else 0
        assert math.floor(rate) <= x.copies <= math.ceil(rate) <= 2
        taken[source] += x.copies * x.size
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in ("a", "b"):
        assert abs(taken[s] - want[s]) < 0.15 * want[s]
    mixed = mixing.mix(df)
    assert mixed.columns == [*df.columns, "mix_copy"]
    assert mixed.count() == sum(x.copies for x in got)
    assert mixing.mix(df.withColumn("mix_copy", F.lit(0))).columns[-1] == "mix_copy_"
    again = Counter((x["__d"].doc_id, x.copies) for x in mixing.mixing_plan(df.repartition(5)).collect())
    assert again == Counter((x["__d"].doc_id, x.copies) for x in got)
    assert mixing.mix(df.limit(0)).count() == 0
