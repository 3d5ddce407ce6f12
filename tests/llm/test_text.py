"""Quotation linking, license scan, HTML blocks and personal data."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import html_blocks, licenses, pii_crf, quotes

# --- quotation linking -----------------------------------------------------

MESSAGES = "conv_id long, turn int, role string, text string, key string, thread string"


def norm(s):
    return re.sub(r"[\x20\x09-\x0D]+", " ", s).strip(" ").lower()


def passages(lines):
    """(level, normalised text, places) of lines, runs, paragraphs and whole levels, by loops."""
    groups = [[i] for i in range(len(lines))]
    for paragraphs in (False, True):
        start = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or lines[i][0] != lines[i - 1][0] or paragraphs and not norm(lines[i - 1][1]):
                groups.append(list(range(start, i)))
                start = i
    groups += [[i for i, x in enumerate(lines) if x[0] == level] for level in {x[0] for x in lines}]
    found = {(lines[g[0]][0], norm(" ".join(lines[i][1] for i in g)), tuple(g)) for g in groups}
    return [p for p in found if p[1]]


def plain_conversations(rows):
    """(conv_id, turn, role, text without linked quotes, reply_to, thread) by loops."""
    msgs = sorted({(c, t, r, x or "") for c, t, r, x, *_ in rows}, key=repr)
    parts, wrote = {}, {}
    for m in msgs:
        c, t, _, x = m
        lines = [(lead.count(">"), line[len(lead):]) for line in x.split("\n") for lead in [re.match(r"[ \t>]*", line)[0]]]
        parts[m] = passages(lines) if c is not None and t is not None else []
        for level, s, _ in parts[m]:
            if level == 0:
                wrote[c, s] = min(t, wrote.get((c, s), t))
    cites, own_of = defaultdict(set), {}
    for m in msgs:
        c, t, _, x = m
        met = [p for p in parts[m] if p[0] > 0 and wrote.get((c, p[1]), t) < t]
        cites[c, t] |= {(level, s) for level, s, _ in met}
        gone = {i for *_, g in met for i in g}
        own_of[m] = "\n".join(line for i, line in enumerate(x.split("\n")) if i not in gone)
    reply = {}
    for (c, t), keys in cites.items():
        votes = defaultdict(int)
        for level, s in keys:
            votes[-level, wrote[c, s]] += 1
        if votes:
            level = max(v[0] for v in votes)
            reply[c, t] = max((n, o) for (lv, o), n in votes.items() if lv == level)[1]
    out = []
    for c, t, r, x in msgs:
        top = t
        while (c, top) in reply:
            top = reply[c, top]
        out.append((c, t, r, own_of[c, t, r, x], reply.get((c, t)), top))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def messages():
    r = random.Random(3)
    rows = []
    for c in range(25):
        said = []
        for t in range(r.randint(1, 9)):
            own = [" ".join(r.choice("alpha beta Gamma delta eps zeta".split()) for _ in range(r.randint(3, 9)))
                   for _ in range(r.randint(1, 3))]
            text = "\n".join(own)
            if said and r.random() < 0.7:
                q = r.choice(said)
                q = r.choice([q, q.split("\n")[0].upper(), q.replace("\n", "  \n")])
                text = "\n".join(r.choice(["> ", ">", " >\t"]) + x for x in q.split("\n")) + "\n" + text
            said.append(text)
            rows.append((c, t, r.choice(["user", "assistant", None]), text, "clash", "clash"))
    rows += [rows[0], rows[0], (None, 0, "user", "> hello", "", ""), (None, 1, "user", "hello", "", ""), (50, None, "user", "> a", "", ""),
             (50, 0, "user", None, "", ""), (50, 1, None, "", "", ""), (51, 0, "user", "same", "", ""), (51, 0, "user", "other", "", ""),
             (51, 3, "user", ">> other\n> same\n" + ">" * 9000, "", ""), (52, 0, "user", "long " * 30000, "", ""),
             (52, 700, "user", "> " + "long " * 30000 + "\nyes", "", "")]
    chain = [(60, t, "user", (f"> step {t - 1}\n" if t else "") + f"step {t}", "", "") for t in range(1200)]
    return rows + chain


def test_links_and_threads(spark, messages):
    got = quotes.linked_messages(spark.createDataFrame(messages, MESSAGES)).collect()
    assert sorted(((x.conv_id, x.turn, x.role, x.text, x.reply_to, x.thread) for x in got), key=repr) == plain_conversations(messages)
    assert max(x.depth for x in got) == 1199
    assert quotes.linked_messages(spark.createDataFrame([], MESSAGES)).count() == 0


def test_conversations_in_reply_order(spark, messages):
    df = spark.createDataFrame(messages, MESSAGES)
    parts = defaultdict(list)
    for x in quotes.conversations(df).collect():
        parts[x.conv_id].append(x)
    assert sum(x.n_messages for v in parts.values() for x in v) == len(set(m[:4] for m in messages))
    assert len(parts[60]) == 3 and len(parts[None]) == 2
    chat = "\n".join(x.chat for x in sorted(parts[60], key=lambda x: (x.thread_part, x.turn_part)))
    assert re.findall(r"step (\d+)", chat) == [str(t) for t in range(1200)]
    assert quotes.conversations(spark.createDataFrame([], MESSAGES)).count() == 0


def test_many_messages_without_a_turn_or_at_one(spark):
    rows = [(1, None, "user", f"> {k}", "", "") for k in range(900)] + [(1, 3, "user", f"> step 2\ntied {k}", "", "") for k in range(400)]
    rows += [(1, t, "user", (f"> step {t - 1}\n" if t not in (0, 4) else "> tied 7\n" if t else "") + f"step {t}", "", "") for t in range(60)]
    out = quotes.conversations(spark.createDataFrame(rows, MESSAGES), limit=50).collect()
    assert sum(x.n_messages for x in out) == len(rows) and max(x.n_messages for x in out) <= 110
    assert len({(x.conv_id, x.thread_part, x.turn_part, x.sub_part) for x in out}) == len(out)
    parts = sorted((x for x in out if x.turn_part is not None), key=lambda x: x.sub_part)
    said = re.findall(r"(step|tied) (\d+)", "\n".join(x.chat for x in parts))
    steps = [int(n) for w, n in said if w == "step"]
    assert steps == list(range(60)) and sum(w == "tied" for w, _ in said) == 400
    assert max(k for k, x in enumerate(said) if x[0] == "tied") < said.index(("step", "4"))


def test_lines_that_quote_nothing_stay(spark):
    texts = [(1, 0, ">>> print(1)\n1"), (1, 1, "> 1\nyes\n> from a book\n>\n> more of it\n- x\n>+ y"), (1, 2, "> yes\n> no"),
             (1, None, "> yes"), (2, 1, "> yes"), (None, 3, "> yes")]
    rows = [(c, t, "user", x, "", "") for c, t, x in texts]
    got = {(x.conv_id, x.turn): (x.text, x.n_quoted) for x in quotes.linked_messages(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got == {(1, 0): (texts[0][2], 0), (1, 1): ("yes\n> from a book\n>\n> more of it\n- x\n>+ y", 1), (1, 2): ("> no", 1),
                   (1, None): ("> yes", 0), (2, 1): ("> yes", 0), (None, 3): ("> yes", 0)}


def test_interleaved_and_rewrapped_quotes(spark):
    first = "intro here\n\nalpha beta gamma delta epsilon zeta\n\neta theta iota kappa\n\nlast words"
    texts = [(1, 0, first),
             (1, 1, "> alpha beta gamma\n> delta epsilon zeta\nanswer one\n> eta theta\n> iota kappa\nanswer two"),
             (1, 2, ">> alpha beta\n>> gamma delta epsilon zeta\n> answer\n> one\nreply"),
             (1, 3, "> answer\n> two\n>\n> something\n> else\nend"), (1, 4, "> never\n> said\nend"),
             (2, 0, "one two\nthree four\n\nfive"), (2, 1, "> one\n> two three four\n>\n> five\nok"), (2, 2, "> one two three\n> four\nok")]
    rows = [(c, t, "user", x, "", "") for c, t, x in texts]
    got = {(x.conv_id, x.turn): x.reply_to for x in quotes.linked_messages(spark.createDataFrame(rows, MESSAGES)).collect()}
    want = {x[:2]: x[4] for x in plain_conversations(rows)}
    assert got == want == {(1, 0): None, (1, 1): 0, (1, 2): 1, (1, 3): 1, (1, 4): None, (2, 0): None, (2, 1): 0, (2, 2): 0}


# --- license scan ----------------------------------------------------------

DOCS = "doc_id long, text string, n_words string, base string, places string"


def plain_scan(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(w))
            if w[k:k + len(phrase.split())] == phrase.split()]
    flat = " " + " ".join(w) + " "
    found = []
    for k, (label, keyword, expr, priority) in enumerate(licenses.rules()):
        if f" {keyword}" in flat:
            for m in re.finditer(f"(?<= )(?:{expr})(?= )", flat):
                start = flat[:m.start()].count(" ") - 1
                found.append((start, start + m[0].count(" ") + 1, priority, k, label))
    kept = [p for p in found if not any(
        o is not p and o[0] <= p[0] and o[1] >= p[1] and (o[2] > p[2] or o[2] == p[2] and ((o[0], o[1]) != (p[0], p[1]) or o[3] < p[3]))
        for o in found)]
    return len(w), base, sorted({p[4] for p in kept} | {label for _, label in base}), max((licenses.CONFIDENCE[p[2]] for p in kept), default=0.0)


LICENSED = [
    None, "", "no words of interest", "!!! ---", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
    "GNU General Public License, version 3 or later", "This work is licensed under CC BY-NC 4.0. CC BY", "SPDX-License-Identifier: MIT",
    "SPDX-License-Identifier: GPL-3.0-or-later", "Creative Commons Attribution ShareAlike 4.0", "https://creativecommons.org/licenses/by-sa/4.0/",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "All rights reserved.",
    "the gnu  general\npublic-license and the MIT license, the Apache License", "MİT License mit licenseé cc by", "cc by cc by-sa 3.0 cc by nd",
    "Mozilla Public License v2.0; Eclipse Public License 2.0; BSD license; 3-clause BSD License", "mit license " * 3000,
    "lesser general public license version 2.1 and GNU lesser general public license", "public domain: dedicated to the public domain",
]


def test_scan_matches_brute_force(spark):
    rows = [(k, t, "clash", "clash", "clash") for k, t in enumerate(LICENSED)] + [(5, LICENSED[5], "", "", "")]
    got = licenses.labelled(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for x in got:
        if len(x["__d"].text or "") > 10_000:
            assert (x.n_words, x.n_base, x.last_word, x.labels) == (6000, 3000, 5998, "mit")
            continue
        n, base, labels, score = plain_scan(x["__d"].text)
        starts = [k for k, _ in base]
        assert (x.n_words, x.n_base, x.first_word, x.last_word) == (n, len(base), min(starts, default=None), max(starts, default=None))
        assert x.base_labels == ",".join(sorted({label for _, label in base}))
        assert (x.labels, x.score) == (",".join(labels), score), x["__d"].text
    by = {x["__d"].doc_id: x.labels for x in got}
    assert by[7] == "cc-by,cc-by-nc-4.0" and by[9] == "gpl-3.0-or-later" and by[12] == "mit"
    assert licenses.labelled(spark.createDataFrame([], DOCS)).count() == 0


def test_the_gate_loses_no_place(spark):
    """A keyword in a text made from a rule's expression starts a word there, and passes the gate."""
    gate = re.compile(licenses.any_keyword().replace(r"\x{10FFFF}", "\U0010ffff"))
    for k, (label, keyword, expr, _) in enumerate(licenses.rules()):
        text = expr
        for a, b in ((r"\(\?:([^()|]*)\|[^()]*\)", r"\1"), (r"\(\?:([^()]*)\)(?:\?|\{\d+,\d+\})", ""), (r"\(\?:([^()]*)\)", r"\1")):
            for _ in range(4):
                text = re.sub(a, b, text)
        text = " " + re.sub(r" ?\?| \.\{1,80\}\?", lambda m: " x" if "." in m[0] else "", text).replace(r"\d", "1").replace("licen[sc]e", "license") + " "
        if re.search(f"(?<= ){expr}(?= )", text):
            assert keyword not in text or f" {keyword}" in text and gate.search(text), (expr, text)


def every_form(parsed):
    """Strings that a parsed expression accepts: all alternatives, optional parts
    with and without, repeats at their least."""
    from re import _constants as C
    forms = [""]
    for op, arg in parsed:
        if op is C.LITERAL:
            more = [chr(arg)]
        elif op is C.ANY:
            more = ["x"]
        elif op is C.IN:
            more = ["1" if k is C.CATEGORY and v is C.CATEGORY_DIGIT else "x" if k is C.CATEGORY else chr(v) for k, v in arg]
        elif op is C.SUBPATTERN:
            more = every_form(arg[3])
        elif op is C.BRANCH:
            more = [f for branch in arg[1] for f in every_form(branch)]
        else:
            assert op in (C.MAX_REPEAT, C.MIN_REPEAT), op
            low, high, body = arg
            more = [f * low for f in every_form(body)] + ([f for f in every_form(body)] if low == 0 else [])
        forms = list(dict.fromkeys(a + b for a in forms for b in more))
    return forms


def test_no_accepted_string_misses_its_keyword():
    gate = re.compile(licenses.any_keyword().replace(r"\x{10FFFF}", "\U0010ffff"))
    n = 0
    for label, keyword, expr, _ in licenses.rules():
        for form in every_form(re._parser.parse(expr)):
            assert re.fullmatch(expr, form)
            assert f" {keyword}" in f" {form} " and gate.search(form.upper().replace(" ", "-\n")), (keyword, form)
            n += 1
    assert n > 10_000


@pytest.mark.parametrize("part", [1, 2])
def test_scan_without_a_gate(spark, part):
    """Names that the keyword of their family is not part of."""
    want = {"released under the FreeBSD license": "bsd-2-clause", "Expat license": "mit", "two clause license": "bsd-2-clause",
            "GFDL v1.3": "gfdl-1.3", "General Public License version 3": "gpl-3.0", "LGPL 2.1": "lgpl-2.1", "gnu agpl v3": "agpl-3.0",
            "You may not use this file except in compliance with the License.": "apache-2.0", "a 4-clause license": "bsd-4-clause",
            "distributed under GPL-2.0 or later": "gpl-2.0-or-later"}
    text = (lambda t: t) if part == 1 else lambda t: f"Some words; {t.upper()}!"
    rows = [(k, text(t), "", "", "") for k, t in enumerate(want)]
    got = {x["__d"].doc_id: x.labels for x in licenses.labelled(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[k] for k in range(len(rows))] == list(want.values())


def test_rules_compile_and_hold_their_keyword():
    rules = licenses.rules()
    assert len(rules) > 200
    for label, keyword, expr, priority in rules:
        re.compile(expr)
        assert priority in licenses.CONFIDENCE and label and keyword


# --- HTML blocks -----------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var t="</p>";</script></head><body class='x'>
<nav><ul><li><a href="/a">Home</a></li><li><a>News<li>Late</ul></nav><!-- <p>not</p> -->
<article><h1>A &amp; B&nbsp;&#233;</h1><p><b>First
 line.<br>second<br><p>A < b, and a<i>b</i>c.<table><tr><td>cell<td>cell 2</table><p title="a > b">Last</article>
<footer>&copy; site</footer><style>p{}</style></body></html>"""


def test_blocks_of_a_page():
    got = [(">".join(t for t, _ in b.path), b.text) for b in html_blocks.blocks(PAGE)]
    assert [t for _, t in got] == ["Home", "News", "Late", "A & B é", "First line. second", "A < b, and abc.", "cell", "cell 2",
                                   "Last", "© site"]
    assert [p.split(">")[-1] for p, _ in got] == ["li", "li", "li", "h1", "p", "p", "td", "td", "p", "footer"]
    for odd in ("", "<", "<p", "<!--", "<script>x", "</div></div>", "<p a='", "text", "<" * 500, "<div>" * 3000 + "deep"):
        html_blocks.blocks(odd)


def test_text_of_rare_elements_is_kept():
    texts = lambda page: [b.text for b in html_blocks.blocks(page)]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds</p>") == ["so x=12 holds"]
    assert texts("<p>a</p><xmp>b <i>c</i> &amp;</xmp><p>d</p>") == ["a", "b <i>c</i> &amp;", "d"]
    assert texts("<object data='x'><p>fallback</p></object><noscript>off</noscript><svg><text>drawn</text></svg>") == ["fallback", "off", "drawn"]
    assert texts("<textarea>no</textarea><iframe>no</iframe><template><p>no</p></template><p>yes</p>") == ["yes"]
    for tag in ("object", "noscript", "svg", "math", "xmp", "iframe", "textarea", "template", "title"):
        assert texts(f"<p>a</p><{tag}><p>b</p><{tag}><p>c</p>") == ["a", "b", "c"], tag
    assert texts("<p>a</p><script>x<p>b</p>") == ["a"] == texts("<p>a</p><style>x<p>b</p>")


@pytest.fixture(scope="module")
def labeller():
    return html_blocks.default_model()


def test_every_training_block_has_its_label():
    for page, labels in html_blocks.labelled_pages(40, seed=8):
        assert len(html_blocks.blocks(page)) == len(labels)


def test_held_out_accuracy(labeller):
    pages = html_blocks.labelled_pages(150, seed=1234)
    flags = html_blocks.label(labeller, [html_blocks.features(html_blocks.blocks(p)) for p, _ in pages])
    hits = [a == b for (_, y), f in zip(pages, flags) for a, b in zip(y, f)]
    assert np.mean(hits) > 0.97


def test_gradients_of_the_network():
    """Back-propagation against finite differences, on one small batch."""
    rng = np.random.default_rng(0)
    h = html_blocks.HIDDEN
    p = {"wxf": rng.normal(0, 0.3, (4, 4 * h)), "whf": rng.normal(0, 0.3, (h, 4 * h)), "bf": rng.normal(0, 0.3, 4 * h)}
    x, w = rng.normal(0, 1, (2, 5, 4)), rng.normal(0, 1, (2, 5, h))
    g = {k: np.zeros_like(v) for k, v in p.items()}
    cache: list = []
    html_blocks._lstm(x, p, "f", cache)
    dx = html_blocks._lstm_back(x, w, p, "f", cache, g)
    loss = lambda: float((html_blocks._lstm(x, p, "f").astype(float) * w).sum())
    for a, grad, at in ((p["wxf"], g["wxf"], (1, 7)), (p["whf"], g["whf"], (3, 50)), (p["bf"], g["bf"], (30,)), (x, dx, (1, 2, 3))):
        old, e = a[at], 1e-2
        a[at] = old + e
        up = loss()
        a[at] = old - e
        down = loss()
        a[at] = old
        assert abs((up - down) / (2 * e) - grad[at]) < 2e-2


def test_labels_do_not_depend_on_the_batch(labeller):
    pages = [html_blocks.features(html_blocks.blocks(p)) for p, _ in html_blocks.labelled_pages(12, seed=3)]
    together = html_blocks.label(labeller, [*pages, ([], [], np.zeros((0, html_blocks.NUMBERS)))])
    assert len(together[-1]) == 0
    for page, flags in zip(pages, together):
        assert (html_blocks.label(labeller, [page])[0] == flags).all()


def test_extract(spark, labeller):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "u", "", "x"), (4, "u", "<nav></nav>", "x"), (1, "u", PAGE, "x"),
            (5, "u", "<html><body><nav><ul><li><a href='/x'>x</a></li></ul></nav><article>" + "<p>Some long words here, as ever.</p>" * 3000
             + "</article><footer>&copy; me</footer></body></html>", "x")]
    got = html_blocks.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    by = defaultdict(list)
    for x in got:
        by[x.page_id].append(x.text)
    assert len(by[1]) == 2 and by[1][0] == by[1][1] and "First line. second" in by[1][0] and "Home" not in by[1][0]
    assert by[2] == [""] and by[None] == [""] and by[4] == [""]
    assert by[5] == ["\n".join(["Some long words here, as ever."] * 3000)]


# --- personal data ---------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and pii_crf.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_match_the_patterns():
    r = random.Random(4)
    texts = ["".join(r.choice("ab1.@+-_ 9()é%") for _ in range(r.randint(0, 60))) for _ in range(4000)]
    texts += [t for t, _ in pii_crf.labelled_table(300, seed=9)] + ["a@b.c@d.e", "@@a@b", "x@y", "1.2.3.4.5.6.7.8", "001.2.3.0255", "+1 2 3 4 5 6 7 8)"]
    for t in texts:
        assert pii_crf.base_spans(t) == plain_base(t), t


def test_long_runs_stay_linear():
    for t in ("a" * 300_000, "1" * 300_000 + "x", "1." * 150_000, "+1" + "(" * 200_000, "a@" * 100_000):
        pii_crf.base_spans(t)


@pytest.fixture(scope="module")
def field():
    return pii_crf.default_model()


def test_field_on_held_out_rows(field):
    hit = miss = wrong = 0
    for text, spans in pii_crf.labelled_table(300, seed=77):
        found = {s[1:] for s in pii_crf._decode(field, [(0, *s) for s in pii_crf.stretches(text)])}
        hit, miss, wrong = hit + len(found & set(spans)), miss + len(set(spans) - found), wrong + len(found - set(spans))
    assert hit / (hit + miss) > 0.95 and hit / (hit + wrong) > 0.95


def test_viterbi_is_the_best_path():
    """Against all paths of short sequences, alone and in a batch."""
    rng = np.random.default_rng(2)
    t, s = pii_crf.TAGS, pii_crf._SHAPES
    model = {"weights": rng.normal(0, 1, (7, s, t)), "trans": rng.normal(0, 1, (t, t)), "start": rng.normal(0, 1, t), "stop": rng.normal(0, 1, t)}
    seqs = [rng.integers(0, s, n + 6) for n in (1, 2, 3, 4, 2)]
    for seq, tags in zip(seqs, pii_crf.viterbi(model, seqs)):
        n = len(seq) - 6
        e = np.stack([sum(model["weights"][o, seq[k + o]] for o in range(7)) for k in range(n)])
        grids = np.stack(np.meshgrid(*[np.arange(t)] * n, indexing="ij"), -1).reshape(-1, n)
        score = model["start"][grids[:, 0]] + model["stop"][grids[:, -1]] + sum(e[k, grids[:, k]] for k in range(n))
        score = score + sum(model["trans"][grids[:, k - 1], grids[:, k]] for k in range(1, n))
        assert (grids[score.argmax()] == tags).all()


def test_find(spark, field):
    call = "call (988) 555-2485 now, or jo.do@mail.org; 10.0.0.1 and +1 (988) 555-2485 "
    rows = [(1, call, "x"), (2, None, "x"), (3, "", "x"), (None, call, "x"), (1, call, "x"), (4, "plain words only. " * 20000, "x"),
            (5, "é" * 10 + call, "x"), (6, "7 " * 40000, "x")]
    got = pii_crf.find(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    by = defaultdict(list)
    for x in got:
        by[x.doc_id].append([(s.kind, s.start, s.end, s.base) for s in x.spans])
    assert len(by[1]) == 2 and by[1][0] == by[1][1] == by[None][0]
    assert by[2] == by[3] == by[4] == [[]]
    assert {s[0] for s in by[1][0] if s[3]} == {"email", "ip", "phone"} and ("phone", 5, 19, False) in by[1][0]
    assert by[5][0] == [(k, a + 10, b + 10, z) for k, a, b, z in by[1][0]]
    for x in got:
        text = dict((r[0], r[1]) for r in rows)[x.doc_id] or ""
        assert [(s.kind, s.start, s.end) for s in x.spans if s.base] == plain_base(text)
