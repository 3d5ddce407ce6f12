"""The prefix trie against a plain walk over all prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from fleetpulse.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_rebuilt(rows):
    """Every conversation's turns (role, text), as the docstring says; rows have no tied turns unless they are equal."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def plain_nodes(rows):
    rebuilt = plain_rebuilt(rows)
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    words = lambda t: sum(bool(w) for w in t.replace("\t", " ").replace("\n", " ").split(" "))
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for key in sorted(members, key=len, reverse=True):
        saved[key] += (len(members[key]) - 1) * (words(key[-1][1]) if key else 0)
        leaves[key] += not children[key]
        if key:
            children[key[:-1]] += 1
            leaves[key[:-1]] += leaves[key]
            saved[key[:-1]] += saved[key]
    ends = lambda key: ",".join(str(c) for c in sorted(members[key]) if len(rebuilt[c]) == len(key))
    return sorted((min(v), len(key), min(members[key[:-1]]) if key else None, len(v), children[key], leaves[key], saved[key],
                   hashlib.sha256(ends(key).encode()).hexdigest()) for key, v in members.items())


def result(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def forest(seed, n=150, span=70):
    """Conversations over few texts, so that prefixes are shared at every depth."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(span * 20, n, replace=False).tolist():
        for turn in range(int(rng.integers(1, 12))):
            rows.append((c, turn, ("user", "assistant")[turn % 2], f"say {rng.integers(0, 1 + turn // 2)}"))
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize("seed,limit", [(1, P.LIMIT), (2, 200), (3, 1)])
def test_nodes(spark, seed, limit):
    rows = forest(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(P.prefix_nodes(df, limit=limit)) == plain_nodes(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no conversation"), (0, None, None, None), (0, 3, "user", "a b"), (0, 1, None, "x"),
            (1, 0, "user", "only turn"), (2, 0, "u", "one"), (2, 0, "u", "one"), (2, 0, "u", "one"), (2, 0, "u", "one"),
            (3, 5, "user", "same"), (3, 5, "user", "same"), (-3, 1, "user", "minus"), (-3, 2, "user", "minus two"),
            (45, 0, "r", "no base"), (4, 0, "a", "bc"), (4, 1, "ab", "c"), (4, 2, "", "abc"), (4, 3, "t", "  "),
            (5, 0, "a", "bc"), (5, 1, "ab", "c"), (5, 2, "", "abc"), (5, 3, "t", "  "), (5, 4, "t", "\n"),
            *[(7, k, "user", "word " * 3) for k in range(300)], *[(8, k, "user", "word " * 3) for k in range(301)],
            (9, 0, "user", "long " * 40_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", conv long, pid int")
    for limit in (P.LIMIT, 50):
        assert result(P.prefix_nodes(df, limit=limit)) == plain_nodes(rows)


def test_one_conversation_over_many_partitions(spark):
    """A third of all rows in one conversation, and its twin."""
    rows = [(c, k, "user", f"t{k % 7}") for c in (400, 417) for k in range(3000)] + forest(5, 60)
    got = P.prefix_nodes(spark.createDataFrame(rows, SCHEMA).repartition(7), limit=1000)
    assert result(got) == plain_nodes(rows)


def test_empty_tables_and_turnless_conversations(spark):
    assert P.prefix_nodes(spark.createDataFrame([], SCHEMA)).count() == 0
    none = [(c, 0, "user", "x") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    assert result(P.prefix_nodes(spark.createDataFrame(none, SCHEMA))) == plain_nodes(none)


def test_query(spark):
    from fleetpulse.llm.queries import op13_prefix_trie
    sf = "/root/testdata/sf0.001"
    df = op13_prefix_trie(spark, sf)
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(df) == plain_nodes(rows)


def test_double_array_finds_every_edge_and_no_other():
    rng = np.random.default_rng(9)
    edges = sorted({(int(rng.integers(0, k + 1)), int(rng.integers(0, 40))) for k in range(600)})
    seen, parent, code = {0}, [], []
    for p, c in edges:                                  # nodes are numbered in order, parents first
        if p in seen:
            parent.append(p)
            code.append(c)
            seen.add(len(parent))
    parent, code = np.array(parent), np.array(code)
    keep = parent <= np.arange(len(parent))
    assert keep.all()
    array = P.DoubleArray(parent, code)
    slot = np.zeros(len(parent) + 1, np.int64)
    for k, (p, c) in enumerate(zip(parent, code)):
        slot[k + 1] = array.step(slot[p:p + 1], np.array([c]))[0]
    assert len(set(slot.tolist())) == len(slot)
    has = set(zip(parent.tolist(), code.tolist()))
    for p in range(len(slot)):
        for c in range(40):
            if (p, c) not in has:
                with pytest.raises(KeyError):
                    array.step(slot[p:p + 1], np.array([c]))
