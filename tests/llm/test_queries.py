"""The registered queries on the small tables, and the pipeline stage by stage
against plain-Python forms."""

import hashlib
import math
import os
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from fleetpulse.llm import decontam, licenses, line_dedup, mixing, outliers, pii_crf, queries, quotes, substring_dedup
from llm.test_counts import concentrate, counts, fill, plain_lines, vector
from llm.test_matching import plain_links, plain_removal
from llm.test_text import plain_base, plain_scan

sys.path.insert(0, os.path.join(os.path.dirname(E.__file__), "tools"))
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def test_one_query_for_every_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.REGISTRY) == list(range(1, 14))
    assert set(queries.REGISTRY) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF, duck(SF))
    assert r["cols_match"] and r["types_match"] and r["values_match"] and r["spark_rows"] > 0, r


def test_op3_oracle_on_quotes(spark, tmp_path):
    """The tables hold no quotes: the SQL and the query on a table that does."""
    from llm.test_text import MESSAGES
    rows = [(c, t, "user" if t % 2 == 0 else "assistant",
             "\n".join([f"> line {c}", *([f">> line {c}"] if t > 3 else []), f"> other {t - 2}"][: t % 4] + [f"line {c}" if t == 0 else f"other {t}"]), "", "")
            for c in range(12) for t in range(9)] + [(None, 0, "user", "> x", "", ""), (1, None, None, None, "", "")]
    rows += [(70, 3, "user", f"> line one\n> two\nmessage {k}", "", "") for k in range(5000)] + [(70, 2, "user", "line one two", "", "")]
    rows += [(70, 4, "user", f"> message {k}\nok {k}\n> not said", "", "") for k in range(3)] + [(None, None, None, "> x", "", "")]
    rows += [(71, 0, "user", "a b\nc\n\nd e", "", ""), (71, 1, None, "> a\n> b c\nand\n> d\n>  E\n>> ab\n", "", "")]
    spark.createDataFrame(rows, MESSAGES).select("conv_id", "turn", "role", "text").toPandas().to_parquet(tmp_path / "conversations.parquet")
    want = duck(str(tmp_path)).execute(queries.ORACLE_SQL["op3_quotation_linking"])
    names = [d[0] for d in want.description]
    got = [tuple(r) for r in queries.op3_quotation_linking(spark, str(tmp_path)).select(*names).collect()]
    rows = want.fetchall()
    assert sorted(got, key=repr) == sorted(rows, key=repr)
    assert sum(r[names.index("n_replies")] for r in rows) > 30


def test_op1_digest(spark, documents):
    got = {r.doc_id: r for r in queries.op1_outliers(spark, SF).collect()}
    assert len(got) == len(documents)
    for i, text, *_ in documents:
        c, r = counts(text), got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c
        assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0]) and not (r.base_failed and r.kept)


def test_op2_digest(spark, documents):
    want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in plain_removal(documents, substring_dedup.WINDOW)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op2_substring_dedup(spark, SF).collect()}
    assert got == want


def test_op4_digest(spark, documents):
    got = {r.doc_id: r for r in queries.op4_license_scan(spark, SF).collect()}
    for i, text, *_ in documents:
        n, base, labels, score = plain_scan(text)
        starts = [k for k, _ in base]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) == (
            n, len(base), min(starts, default=None), max(starts, default=None), ",".join(labels), score)


def test_op5_digest(spark):
    """The pages' articles are known by their tag."""
    from fleetpulse.llm.html_blocks import blocks
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op5_html_blocks(spark, SF).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    want = {i: "\n".join(b.text for b in blocks(h) if any(t == "article" for t, _ in b.path)) for i, h in pages.items()}
    assert sum(want[r.page_id] == r.text for r in got) >= 0.98 * len(got)


def test_op6_digest(spark, documents):
    got = {r.doc_id: r for r in queries.op6_pii_crf(spark, SF).collect()}
    for i, text, *_ in documents:
        base = plain_base(text or "")
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        n = Counter(k for k, *_ in base)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii_crf.KINDS)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))


def test_op7_digest(spark, documents):
    want, _ = plain_links(documents)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in queries.op7_forest_join(spark, SF).collect()), key=repr) == want


def test_op10_digest(spark, documents):
    items = {r.item_id: b" ".join(decontam.tokens(r.text.encode())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(i, k) for i, text, *_ in documents for k, x in items.items() if x in b" ".join(decontam.tokens((text or "").encode()))}
    got = {(r.doc_id, r.item_id) for r in queries.op10_decontamination(spark, SF).collect()}
    assert want and want <= got


def test_pipeline_stage_by_stage(spark, documents):
    rows = documents
    groups = defaultdict(list)
    for r in rows:
        c = counts(r[1])
        if not (c[0] < 50 or 100 * c[4] > 50 * c[0]):
            groups[r[2], r[3]].append(r)
    kept = [r for g in groups.values() for r, d in zip(g, concentrate(np.array([vector(x[1]) for x in g], float))) if d <= outliers.CUTOFF]
    texts = {i: t for i, t, *_ in plain_lines(kept, line_dedup.RATIO, line_dedup.MIN_PAGES)}
    lined = [(r[0], texts[r[0]], *r[2:]) for r in kept]
    classes = plain_links(lined)[0]
    single = [r for r in lined if r[0] in {c for _, c, _ in classes}]
    items = [(r.item_id, decontam.tokens(r.text.encode())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontam.Index(items)
    leaked = {d for d, _, _ in index.search([r[1].encode() for r in single])}
    clean = [r for k, r in enumerate(single) if k not in leaked]
    sizes = Counter()
    for r in clean:
        sizes[r[3]] += len(r[1].split())
    target = fill(sizes)
    want = Counter()
    for i, text, _, source in clean:
        rate = target[source] / sizes[source]
        draw = int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:8], 16) / 2**32
        want[i, text] += math.floor(rate + 1e-12) + (draw < rate - math.floor(rate + 1e-12))
    want = Counter({k: v for k, v in want.items() if v})

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for (name, fn), expected in zip(corpus_pipeline.STAGES, (kept, lined, single, clean, None)):
        out = fn(spark, docs, SF)
        if expected is not None:
            assert out.columns == docs.columns, name
            assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((r[0], r[1]) for r in expected), name
            docs = out
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    assert corpus_pipeline.run(spark, SF).columns == [*spark.read.parquet(f"{SF}/documents.parquet").columns, "mix_copy"]


def test_modules_do_not_reach_into_the_subpackage():
    root = os.path.dirname(E.__file__)
    for folder, _, names in os.walk(os.path.join(root, "fleetpulse")):
        for n in names:
            if n.endswith(".py") and not folder.endswith("llm"):
                text = open(os.path.join(folder, n)).read()
                assert "fleetpulse.llm" not in text and "from .llm" not in text and "from ..llm" not in text
    assert quotes and licenses and F
