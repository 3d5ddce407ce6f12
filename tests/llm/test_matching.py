"""Substring dedup, near duplicates and decontamination against brute force."""

import math
import os
import random
import subprocess
import sys
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from fleetpulse.llm import components, decontam, forest_join, substring_dedup

SCHEMA = "doc_id long, text string, bucket string, key string, tag string, n string"


def row(i, text):
    return (i, text, "clash", "clash", "clash", "clash")


def corpus(seed, vocabulary=300, n=140):
    r = random.Random(seed)
    words = [f"t{k}" for k in range(vocabulary)]
    prose = lambda k: [r.choice(words) for _ in range(k)]
    passage, texts = prose(45), []
    for _ in range(n):
        w = prose(r.randint(0, 90))
        if r.random() < 0.3:
            at = r.randint(0, len(w))
            w[at:at] = passage[r.randint(0, 10):]
        texts.append(w)
    for _ in range(40):  # near copies
        w = list(r.choice(texts))
        for _ in range(r.randint(0, 3)):
            if w:
                w[r.randrange(len(w))] = "changed"
        texts.append(w)
    out = [row(k, " ".join(w)) for k, w in enumerate(texts)]
    r.shuffle(out)
    return out, r


# --- substring dedup -------------------------------------------------------

def ascii_words(text):
    return [w.decode() for w in (text or "").encode().split()]      # no-break spaces are part of a word


def plain_removal(rows, size):
    first = {}
    for i, text, *_ in rows:
        w = ascii_words(text)
        for k in range(len(w) - size + 1):
            at = (i is None, i or 0, k)
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, at), at)
    out = []
    for i, text, *_ in rows:
        w = ascii_words(text)
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < (i is None, i or 0, k):
                gone |= set(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def test_removal_matches_brute_force(spark):
    rows, r = corpus(1)
    loop = " ".join(["again"] * 70)
    rows += [row(900, None), row(901, ""), row(902, loop), row(None, loop), row(None, rows[0][1]), row(-5, rows[3][1]),
             row(903, " ".join(str(k % 997) for k in range(30000))), row(904, "é ü x " * 20)]
    rows += [rows[4], rows[4], row(rows[5][0], rows[6][1])]         # repeated rows, and one id with two texts
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(((x.doc_id, x.n_words, x.n_removed, x.kept) for x in substring_dedup.remove_repeats(df).collect()), key=repr)
    assert got == plain_removal(rows, substring_dedup.WINDOW)
    assert sum(g[2] for g in got) > 1000
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0


def test_intervals_are_maximal(spark):
    text = " ".join(f"x{k}" for k in range(50))
    out = substring_dedup.remove_repeats(spark.createDataFrame([row(1, text), row(2, "a b " + text + " c")], SCHEMA)).collect()
    assert {x.doc_id: [(s.start, s.end) for s in x.removed] for x in out} == {1: [], 2: [(2, 52)]}


def test_window_hash_is_the_polynomial():
    w = np.random.default_rng(1).integers(0, 2**64, 60, dtype=np.uint64)
    p = (1 << 61) - 1
    for size in (1, 5, 13, 20):
        got = substring_dedup.window_hashes(w, size)
        for k in (0, 7, 60 - size):
            h = 0
            for x in w[k:k + size]:
                h = (h * substring_dedup._BASE + int(x) % p) % p
            assert int(got[k]) == h
    assert len(substring_dedup.window_hashes(w[:5], 20)) == 0


def test_packing_round_trip():
    rng = np.random.default_rng(3)
    n = 5000
    bucket = np.sort(rng.integers(0, 9, n))
    doc = rng.choice([-2**62, -1, 0, 5, 2**40, substring_dedup.NULL_ID], n)
    tag = rng.integers(0, 3, n).astype(np.uint32) * np.uint32(2**31 - 1)
    pos = rng.integers(0, 10**6, n)
    rest = rng.integers(0, 2**55, n, dtype=np.uint64)
    o = np.lexsort((pos, tag, doc, bucket))
    bucket, doc, tag, pos, rest = bucket[o], doc[o], tag[o], pos[o], rest[o]
    parts = []
    for b, h, d, t, c, p in substring_dedup.pack(bucket, doc, tag, pos, rest):
        x = substring_dedup.unpack(d, t, c, p)
        raw = np.zeros((len(x[0]), 8), np.uint8)
        raw[:, :7] = np.frombuffer(h, np.uint8).reshape(-1, 7)
        parts.append((np.full(len(x[0]), b), *x, raw.view("<u8").reshape(-1)))
    for want, got in zip((bucket, doc, tag, pos, rest), (np.concatenate(z) for z in zip(*parts))):
        assert (want == got).all()


# --- near duplicates -------------------------------------------------------

def plain_links(rows, limit=0.8):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = Counter()
    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= limit * (len(sets[a]) + len(sets[b]) - both) - 1e-12:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    classes = defaultdict(list)
    for k in range(len(rows)):
        classes[find(k)].append(rows[k][0])
    ids = {k: min((i for i in v if i is not None), default=None) for k, v in classes.items()}
    return sorted(((rows[k][0], ids[find(k)], links[k]) for k in range(len(rows))), key=repr), len(classes)


@pytest.mark.parametrize("block", [forest_join.BLOCK, 7])
def test_links_match_brute_force(spark, block):
    rows, r = corpus(5, vocabulary=4000)
    base = rows[0][1].split() or ["x"] * 30
    base = [f"b{k}" for k in range(120)]
    for k in range(40):  # one large group of different near copies
        w = list(base)
        w[r.randrange(len(w))] = f"v{k}"
        rows.append(row(3000 + k, " ".join(w)))
    rows += [row(900, None), row(901, ""), row(902, "  "), row(903, "one two"), row(904, "one  two"), row(905, "one"),
             row(None, " ".join(base)), row(None, "alone without id " * 3), row(906, " ".join(f"z{k}" for k in range(20000)))]
    rows += [rows[7], rows[7]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = forest_join.near_duplicates(df, block=block).collect()
    want, n_classes = plain_links(rows)
    assert sorted(((x.doc_id, x.class_id, x.n_links) for x in found), key=repr) == want


def test_keep_one_of_every_class(spark):
    rows, _ = corpus(6, vocabulary=4000)
    rows += [row(900, None), row(901, ""), rows[3], rows[3]]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = forest_join.keep_one(df)
    assert kept.columns == df.columns
    _, n_classes = plain_links(list(dict.fromkeys(rows)))
    ids = [x.doc_id for x in kept.collect()]
    assert len(ids) == n_classes and len(set(ids)) == len(ids) and {900, 901} <= set(ids)
    assert forest_join.keep_one(df.limit(0)).count() == 0


def test_recall_of_the_trees_alone():
    """Pairs at the threshold share a label as often as the bound says."""
    r = random.Random(3)
    depth = forest_join.prefix_depth()
    assert forest_join.recall(depth, forest_join.TREES, 0.8) >= forest_join.TARGET_RECALL
    assert forest_join.recall(depth + 1, forest_join.TREES, 0.8) < forest_join.TARGET_RECALL
    hit = 0
    for k in range(150):
        w = [f"{k}-{j}" for j in range(110)]
        v = list(w)
        for _ in range(2):
            v[r.randrange(len(v))] = "other"
        label, _ = forest_join.labels([" ".join(w).encode(), " ".join(v).encode()], depth)
        hit += bool((label[0] == label[1]).any())
    assert hit >= 149


def test_components(spark):
    r = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [
        (r.randint(200, 400), r.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x.vertex: x.root for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in linked}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- decontamination -------------------------------------------------------

def test_leaks(spark):
    r = random.Random(8)
    words = [f"q{k}" for k in range(500)]
    items = [(k, " ".join(r.choice(words) for _ in range(r.randint(13, 50)))) for k in range(30)]
    items += [(100, "tiny one"), (101, None), (102, ""), (103, "exactly six tokens stand here now"), (0, items[0][1])]
    docs, want = [], set()
    for k in range(200):
        w = [r.choice(words) for _ in range(r.randint(0, 120))]
        if k % 4 == 0:
            item, text = items[r.randrange(30)]
            t = [x.upper() + "," for x in text.split()]
            for _ in range(len(t) // 15):
                t[r.randrange(len(t))] = "substituted"
            at = r.randint(0, len(w))
            w[at:at] = t
            want.add((k, item))
            if item == 0:
                want.add((k, 0))
        docs.append(row(k, " ".join(w)))
    docs += [row(900, None), row(901, ""), row(902, "so Exactly six tokens, stand here now!"), row(None, items[4][1]),
             row(903, ("filler " * 20000) + items[5][1])]
    want |= {(902, 103), (None, 4), (903, 5)}
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.leaks(df, bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want
    assert sum(x.item_id == 0 for x in got) == 2 * len([w for w in want if w[1] == 0])
    leaked = {i for i, _ in want}
    clean = decontam.drop_leaked(df, bench)
    assert clean.columns == df.columns
    assert Counter(x.doc_id for x in clean.collect()) == Counter(d[0] for d in docs if d[0] not in leaked)
    assert decontam.leaks(df, bench.limit(0)).count() == 0
    assert decontam.leaks(df.limit(0), bench).count() == 0


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    r = random.Random(2)
    words = [f"q{k}" for k in range(500)]
    items = [(k, " ".join(r.choice(words) for _ in range(20))) for k in range(12)]
    docs = spark.createDataFrame([row(k, items[k % 12][1] + " tail") for k in range(30)] + [row(99, "clean text")], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(decontam.leaks(docs, bench).collect())
    monkeypatch.setattr(decontam, "BLOCK_TOKENS", 50)
    assert sorted(decontam.leaks(docs, bench).collect()) == whole and len(whole) == 30
    assert [x.doc_id for x in decontam.drop_leaked(docs, bench).collect()] == [99]


def test_a_document_that_starts_inside_an_item(spark):
    """The item would start in the gap before the document, or in the one before that."""
    item = [f"q{k}" for k in range(20)]
    for cut in range(1, 8):
        texts = [" ".join(f"p{k}" for k in range(10)), " ".join(item[cut:]), None, " ".join(item[cut:]) + " more", "end"]
        index = decontam.Index([("i", [w.encode() for w in item])])
        found = [(d, seg) for d, _, seg in index.search([t.encode() if t else t for t in texts])]
        assert found == [(d, (20 - cut, 20 - cut, 0, cut)) for d in (1, 3)]
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], SCHEMA).coalesce(1)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert sorted(x.doc_id for x in decontam.leaks(docs, bench).collect()) == [1, 3]
    assert sorted(x.doc_id for x in decontam.drop_leaked(docs, bench).collect()) == [0, 2, 4]


def plain_leak(doc, item):
    """Whether a segment of a diagonal has the equal tokens at 80 %, and the most equal tokens of one."""
    need, best = min(12, math.ceil(len(item) * 0.8 - 1e-9)), 0
    for offset in range(-len(item), len(doc)):
        eq = [doc[offset + k] == x if 0 <= offset + k < len(doc) else None for k, x in enumerate(item)]
        eq = [e for e in eq if e is not None]
        for i in range(len(eq)):
            same = 0
            for j in range(i, len(eq)):
                same += eq[j]
                if same * 5 >= (j - i + 1) * 4:
                    best = max(best, same)
    return best if best >= need else 0


def found_leak(doc, item):
    index = decontam.Index([(0, [w.encode() for w in item])])
    return next((seg for _, _, seg in index.search([b"", " ".join(doc).encode()])), (0,))


def test_leaks_by_definition():
    item = [f"q{k}" for k in range(46)]
    doc = [f"x{k}" if k in (12, 13, 14, 15, 16, 29, 30, 31, 32, 33) else w for k, w in enumerate(item)]
    assert found_leak(doc, item) == (24, 29, 0, 0) and plain_leak(doc, item) == 24          # all three runs: 78 %
    r = random.Random(12)
    hits = 0
    for k in range(300):
        item = [f"q{j}" for j in range(r.choice([5, 7, 11, 15, 20, 40, 60]))]
        doc = [f"x{j}" if r.random() < 0.22 else w for j, w in enumerate(item)]
        doc = doc[r.randint(0, 3):len(doc) - r.randint(0, 2)] + ["y"] * r.randint(0, 4)
        seg = found_leak(doc, item)
        assert seg[0] == plain_leak(doc, item), (doc, seg)
        if seg[0]:
            n, size, d, i = seg
            assert n * 5 >= size * 4 and n == sum(doc[d + x] == item[i + x] for x in range(size))
            assert doc[d] == item[i] and doc[d + size - 1] == item[i + size - 1]
            hits += 1
    assert 100 < hits < 290


@pytest.mark.parametrize("heavy, cells", [(0, 50), (3, 7), (10**6, 10**6)])
def test_repeating_tokens_and_short_items(monkeypatch, heavy, cells):
    """Few different tokens: many diagonals hold seeds, by runs or written out."""
    monkeypatch.setattr(decontam, "HEAVY", heavy)
    monkeypatch.setattr(decontam, "CELLS", cells)
    r = random.Random(3)
    hits = 0
    for k in range(250):
        words = ["a"] * r.choice([1, 4]) + [f"b{j}" for j in range(r.choice([0, 1, 2, 30]))]
        items = [[r.choice(words) for _ in range(r.choice([1, 2, 3, 4, 6, 12, 25]))] for _ in range(r.choice([1, 3]))]
        docs = [[r.choice(words) for _ in range(r.choice([0, 3, 20, 60]))] for _ in range(3)]
        index = decontam.Index([(j, [w.encode() for w in x]) for j, x in enumerate(items)])
        found = {(d, j): seg for d, j, seg in index.search([" ".join(d).encode() for d in docs])}
        assert {key: seg[0] for key, seg in found.items()} == {
            (d, j): best for d in range(3) for j in range(len(items)) if (best := plain_leak(docs[d], items[j]))}
        for (d, j), (n, size, a, b) in found.items():
            assert n * 5 >= size * 4 and n == sum(docs[d][a + x] == items[j][b + x] for x in range(size))
        hits += len(found)
    assert hits > 400


def test_ten_megabytes_of_one_token():
    """Seconds and memory of a process of its own."""
    code = """
import resource, time
from fleetpulse.llm import decontam
index = decontam.Index([(0, [b"a"] * 300), (1, [b"a"])])
start = time.monotonic()
found = list(index.search([b"a " * 5_000_000, b"b " * 10]))
assert found == [(0, 0, (300, 300, 4_999_700, 0)), (0, 1, (1, 1, 4_999_999, 0))], found
print(time.monotonic() - start, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    root = os.path.dirname(os.path.dirname(decontam.__file__)) + "/.."
    spent, peak = subprocess.run([sys.executable, "-c", code], cwd=root, check=True, capture_output=True, text=True).stdout.split()
    assert float(spent) < 60 and int(peak) < 500_000        # kB


@pytest.mark.parametrize("size", range(1, 16))
def test_seeds_find_every_place_of_substitutions(size):
    item = [f"q{k}" for k in range(size)]
    need = min(12, math.ceil(size * 0.8 - 1e-9))
    for places in combinations(range(size), size - need):
        doc = ["x" if k in places else w for k, w in enumerate(item)]
        assert found_leak(doc, item)[0] == need, places


def test_seeds_of_long_items_miss_no_segment():
    """The fewest substitutions of a string that no mask hits, by its length:
    always more than a leak may have."""
    masks = [int(m, 2) for m in decontam.MASKS]
    fewest = {0: 0}
    for size in range(1, 120):
        step = {}
        for state, n in fewest.items():
            for bit in (0, 1):
                s = (state << 1 | bit) & 63
                if not any(s & m == m for m in masks):
                    step[s] = min(step.get(s, size), n + 1 - bit)
        fewest = step
        assert size < 12 or min(fewest.values()) > min(size - 12, size // 5)
