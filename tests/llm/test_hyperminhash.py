"""HyperMinHash groups against exact similarities of all pairs."""

import re

import numpy as np
import pytest

from fleetpulse.llm import hyperminhash as H


def plain_sets(rows):
    low = {i: i + 32 for i in range(65, 91)}
    out = []
    for _, text in rows:
        w = [x for x in re.split("[\x20\x09-\x0D]+", (text or "").translate(low)) if x]
        out.append(frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset())
    return out


def plain_groups(rows):
    """(id, set size, smallest id reachable, kept) of every row."""
    sets = plain_sets(rows)
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for (doc_id, _), s, g in zip(rows, sets, group):
        ids = [r[0] for r, x in zip(rows, group) if x == g and r[0] is not None]
        low = (min(ids) if ids else None) if s else doc_id
        out.append((doc_id, len(s), low, doc_id == low))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def near_copies(seed, groups=8, each=12):
    """Groups of copies with a few to a fifth of their words changed, so that many pairs
    lie around the threshold and many links run over third texts."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{k}" for k in rng.integers(0, 3000, int(rng.integers(1, 120)))]
        for _ in range(each):
            words = list(base)
            for k in rng.integers(0, len(words), int(rng.integers(0, max(2, len(words) // 15)))):
                words[k] = f"w{rng.integers(0, 3000)}"
            rows.append((len(rows) * 7 % 1000, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,block", [(1, 256), (2, 2)])
def test_groups(spark, seed, block):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(H.near_duplicates(docs, block_texts=block)) == plain_groups(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two three"), (7, "one  two\nTHREE"),
            (8, "É a b c d"), (9, "é a b c d"), (None, "null id text of some words"), (10, "null id text of some words"),
            (None, "alone without id"), (11, "repeated row of five"), (11, "repeated row of five"),
            (12, " ".join(f"x{i}" for i in range(30_000))), (13, " ".join(f"X{i}" for i in range(29_000))), (None, None)]
    docs = spark.createDataFrame([(*r, 0, "s") for r in rows], "doc_id long, text string, vid int, regs string")
    want = [(i, n, c, (i == c) if (i, c) != (None, None) else True) for i, n, c, _ in plain_groups(rows)]
    assert result(H.near_duplicates(docs)) == want


def test_an_empty_table(spark):
    assert H.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    from fleetpulse.llm.queries import op12_hyperminhash
    sf = "/root/testdata/sf0.001"
    df = op12_hyperminhash(spark, sf)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(df) == plain_groups(rows)


def test_words_as_python_splits_them():
    texts = [b"a b", b"", None, b"\x0bAb  aB\x0c", b"x" * 5000 + b" y", b"ab ba"]
    w, n = H.word_hashes(texts)
    assert n.tolist() == [2, 0, 0, 2, 2, 2]
    assert w[2] == w[3] == w[6] and len(set(w.tolist())) == 6


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(4)
    for shared, each in ((4, 1), (40, 5), (400, 50), (4000, 500)):
        true, got = shared / (shared + 2 * each), []
        for _ in range(40):
            both = rng.integers(0, 2**64, shared, dtype=np.uint64)
            own = rng.integers(0, 2**64, (2, each), dtype=np.uint64)
            regs = H.registers(np.concatenate([both, own[0], both, own[1]]), np.array([shared + each] * 2))
            size = np.array([float(shared + each)])
            got.append(H.estimate(regs[:1], regs[1:], size, size)[0])
        assert abs(np.mean(got) - true) < 0.03 and min(got) > true - H.MARGIN


def test_chance_equal_registers():
    """Sets without a common shingle agree as often as the correction says."""
    rng = np.random.default_rng(5)
    for n in (600, 12_000):
        h = rng.integers(0, 2**64, 400 * n, dtype=np.uint64) if n < 1000 else rng.integers(0, 2**64, 60 * n, dtype=np.uint64)
        regs = H.registers(h, np.full(len(h) // n, n))
        same = np.mean([(regs[i] == regs[j]).mean() for i in range(len(regs)) for j in range(i)])
        chance = H.chance_equal(np.array([float(n)]), np.array([float(n)]))[0]
        assert chance / 2 < same < chance * 2


def test_recall_of_the_bands_at_the_threshold():
    assert 1 - (1 - H.THRESHOLD**H.ROWS)**H.BANDS > 0.9999
