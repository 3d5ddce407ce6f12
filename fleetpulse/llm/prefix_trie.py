"""Conversation prefix trie on double arrays.

Conversations are sequences of (role, text) turns. ``rebuilt_turns`` gives conversation c
the first h turns of conversation c - c % ``GROUP`` (h = crc32(c) % ``HEADS``) and its own
turns after its first h. ``prefix_nodes`` returns every distinct prefix of the
sequences: a node of their trie, with aggregates of its members and its subtree.

Method: equal sequences become one with a count. A prefix is known by 128 bits, the running
XOR of hashes of (turn, place). Prefixes of one sequence only are its tail: a tail has
no branches, so its values follow from running sums. The shared prefixes are cut
into shards: a prefix with more than ``LIMIT`` turns below it is an upper node, a
shard begins where that falls to ``LIMIT`` or less. A task packs the shards of a bin
into one double array: the turns get dense ids, the children of the node at slot s lie at
BASE[s] + id with CHECK = s; walking all sequences through it gives every node's
members, and summing over CHECK from the deepest nodes up gives its subtree. Shards
hand their totals to the upper nodes above them, which are summed globally.

Scale: texts are never shuffled, only their hashes and word counts. Places and running
XORs are computed inside range partitions over (conversation, turn) and completed by one
row per partition, so one conversation may hold any share of the rows. Bins hold about
``LIMIT`` rows and a shard no more than that, whatever the share of a first turn. A
contribution to upper nodes is one row per ancestor; there are at most (all
turns / LIMIT) upper nodes of one depth. The ids of equal conversations are hashed one
after the other from a sorted stream, never gathered (SHA-256 has no other way).

Defined results: rows without a conversation id belong to none; NULL roles and texts are
empty; a NULL turn comes first; turns that tie are ordered by a hash of role and
text, repeated rows are repeated turns; ids are whole numbers, and c % 20 has the sign
of c; a table without conversations has no nodes, not even a root. Other columns
are not read and cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sizing import partitions_for
from .common import n_words, stage

GROUP = 20
HEADS = 4
LIMIT = 100_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
KEY = ["d", "p1", "p2"]


def _runs(keys: np.ndarray, last: int | None) -> tuple[np.ndarray, np.ndarray]:
    """First positions of the runs of equal keys, and each position's run;
    the first run goes on with the previous batch's if ``last`` is its key."""
    new = np.concatenate([[len(keys) > 0 and keys[0] != last], keys[1:] != keys[:-1]])
    return np.flatnonzero(new), np.cumsum(new)


def _place_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the place of every turn inside its conversation's rows of this
    partition (from 1), in sorted order."""
    last, count = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(1).to_numpy()
        firsts, run = _runs(keys, last)
        begin = np.concatenate([[-count], firsts])[run]
        place = np.arange(len(keys)) - begin + 1
        last, count = int(keys[-1]), int(place[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])


def _running_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces g1, g2 by their running XOR before and including each turn, and
    adds the running words, per conversation inside this partition."""
    last, carry = None, [0, 0, 0]
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(1).to_numpy()
        firsts, run = _runs(keys, last)
        out = {c: batch.column(c) for c in batch.schema.names if c not in ("g1", "g2")}
        for k, (c, op, undo) in enumerate((("g1", np.bitwise_xor, np.bitwise_xor), ("g2", np.bitwise_xor, np.bitwise_xor),
                                           ("w", np.add, np.subtract))):
            x = batch.column(c).to_numpy()
            total = op.accumulate(x)
            # what had run up before the conversation began; the open one goes on from the carry
            before = np.concatenate([[undo(0, carry[k]) if c == "w" else carry[k]], undo(total[firsts], x[firsts])])[run]
            through = undo(total, before)
            carry[k] = int(through[-1])
            out[f"l{k + 1}"] = pa.array(through)
            if c != "w":
                out[f"b{k + 1}"] = pa.array(undo(through, x))
        last = int(keys[-1])
        yield pa.RecordBatch.from_pydict({c: out[c] for c in _RUNNING})


_RUNNING = ["pid", "conv", "d", "t1", "t2", "w", "l1", "l2", "b1", "b2", "l3"]
_RUNNING_TYPES = ", ".join(f"{c} {'int' if c in ('pid', 'd') else 'long'}" for c in _RUNNING)


def _ranged(df: DataFrame, *order) -> DataFrame:
    """Range-partitioned and sorted by the order, with the partition's number."""
    n = partitions_for(df)
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id())


def _before(parts: DataFrame, **sums) -> DataFrame:
    """For conversations over several partitions: what their earlier
    partitions add up to, one row per (conversation, partition)."""
    w = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return (parts.select("conv", "pid", *[agg.over(w).alias(name) for name, agg in sums.items()])
            .filter(" AND ".join(f"{name} IS NOT NULL" for name in sums)))


def _turns(convs: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, place (from 1), t1, t2 (hashes of role and text), w (words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = convs.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(13), text, role).alias("t2"),
                        n_words(F.col(text_col)).alias("w")).filter("conv IS NOT NULL")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2"), F.col("tie")]
    placed = _ranged(rows.withColumn("tie", F.monotonically_increasing_id()), *order)
    placed = stage(placed.select("pid", "conv", "t1", "t2", "w").mapInArrow(
        _place_task, "pid int, conv long, t1 long, t2 long, w long, place long"), "trie-turns")
    before = _before(placed.groupBy("conv", "pid").agg(F.max("place").alias("n")), more=F.sum("n"))
    return placed.join(before, ["conv", "pid"], "left").select(
        "conv", (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"), "t1", "t2", "w")


def rebuilt_turns(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(ids, turns): every conversation's id, and its rebuilt turns (conv, d, t1, t2, w)."""
    turns = _turns(convs, id_col, turn_col, role_col, text_col)
    one = F.struct("place", "t1", "t2", "w")
    heads = (turns.filter((F.col("conv") % GROUP == 0) & (F.col("place") < HEADS))
             .groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(one)).alias("heads")))
    ids = (turns.select("conv").distinct().withColumn("base", F.col("conv") - F.col("conv") % GROUP)
           .withColumn("h", (F.crc32(F.col("conv").cast("string")) % HEADS).cast("int")))
    ids = ids.join(heads, "base", "left").select("conv", "h", F.coalesce(F.slice("heads", 1, F.col("h")), F.array()).alias("first"))
    ids = stage(ids, "trie-ids")
    copied = ids.select("conv", F.posexplode("first").alias("i", "e")).select(
        "conv", (F.col("i") + 1).alias("d"), "e.t1", "e.t2", "e.w")
    own = turns.join(ids.select("conv", "h", F.size("first").alias("n")), "conv").filter("place > h").select(
        "conv", (F.col("place") - F.col("h") + F.col("n")).cast("int").alias("d"), "t1", "t2", "w")
    return ids.select("conv"), copied.unionByName(own)


class DoubleArray:
    """BASE and CHECK of a trie given by its nodes' parents (0 is the root,
    parents come before children) and the ids on the edges to them."""

    #: Slots tried for a branching node before it goes behind the last one.
    TRIES = 64

    def __init__(self, parent: np.ndarray, code: np.ndarray):
        n = len(parent) + 1                                # nodes, the root included
        children = np.bincount(parent, minlength=n)
        order = np.lexsort((code, parent))
        start = np.concatenate([[0], np.cumsum(children)])
        base = np.zeros(n, np.int64)
        taken = np.zeros(2 * n + int(code.max(initial=0)) + 2, bool)
        taken[0] = True                                    # the root's slot
        free, top = 1, 1
        branching = np.flatnonzero(children > 1)
        for s in branching[np.argsort(-children[branching], kind="stable")]:
            codes = code[order[start[s]:start[s + 1]]]
            while free < len(taken) and taken[free]:
                free += 1
            at, tries = free, 0
            while True:
                slots = at + codes - codes[0]
                if slots[-1] >= len(taken):
                    taken = np.concatenate([taken, np.zeros(max(len(taken), int(slots[-1]) + 1), bool)])
                if not taken[slots].any():
                    break
                tries += 1
                at = max(top, at + 1) if tries > self.TRIES else at + 1
            base[s] = at - codes[0]
            taken[slots] = True
            top = max(top, int(slots[-1]) + 1)
        single = np.flatnonzero(children == 1)
        codes = code[order[start[single]]]
        gaps = np.flatnonzero(~taken)[:len(single)]
        gaps = np.concatenate([gaps, len(taken) + np.arange(len(single) - len(gaps))])
        base[single] = gaps - codes
        slot = np.zeros(n, np.int64)
        slot[1:] = base[parent] + code
        size = int(slot.max()) + 1
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent]

    def step(self, slot: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The children over the ids; raises where there is none."""
        to = self.base[slot] + code
        if (to < 1).any() or (to >= len(self.check)).any() or (self.check[to] != slot).any():
            raise KeyError("no such child")
        return to


_NODE = ["d", "p1", "p2", "b1", "b2", "conv", "n_convs", "n_children", "n_leaves", "saved", "parent", "top"]
_NODE_TYPES = ", ".join(f"{c} {'int' if c == 'd' else 'boolean' if c == 'top' else 'long'}" for c in _NODE)


def _trie_task(table: pa.Table) -> pa.Table:
    """The nodes of the shards of one bin."""
    x = {c: table.column(c).to_numpy() for c in table.column_names}
    order = np.lexsort((x["d"], x["rep"]))
    x = {c: v[order] for c, v in x.items()}
    n = len(order)
    pair = lambda a, b: np.unique(np.stack([a, b], 1), axis=0, return_inverse=True)[1].reshape(-1)
    code = pair(x["t1"], x["t2"])
    level = x["d"] - x["u"] - 1
    begin = level == 0
    # the root's edges are the shards, not their first turns: equal turns may begin several
    code[begin] = int(code.max()) + 1 + pair(x["s1"], x["s2"])[begin]
    by_level = [np.flatnonzero(level == k) for k in range(int(level.max()) + 1)]
    node, parents, codes, n_nodes = np.zeros(n, np.int64), [], [], 1
    for k, at in enumerate(by_level):
        parent = node[at - 1] if k else np.zeros(len(at), np.int64)
        edge, which = np.unique(np.stack([parent, code[at]], 1), axis=0, return_inverse=True)
        node[at] = n_nodes + which.reshape(-1)
        n_nodes += len(edge)
        parents.append(edge[:, 0])
        codes.append(edge[:, 1])
    array = DoubleArray(np.concatenate(parents), np.concatenate(codes))

    size = len(array.check)
    members, children, leaves, saved = (np.zeros(size, np.int64) for _ in range(4))
    conv, row = np.full(size, np.iinfo(np.int64).max), np.full(size, -1)
    slot = np.zeros(n, np.int64)
    for k, at in enumerate(by_level):
        slot[at] = array.step(slot[at - 1] if k else np.zeros(len(at), np.int64), code[at])
    np.add.at(members, slot, x["m"])
    np.minimum.at(conv, slot, x["rep"])
    row[slot] = np.arange(n)
    used = np.flatnonzero(row >= 0)
    saved[used] = (members[used] - 1) * x["w"][row[used]]
    # tails hang on the last shared prefix of their sequence
    tail = (x["d"] == x["e"]) & (x["len"] > x["e"])
    np.add.at(children, slot[tail], 1)
    np.add.at(leaves, slot[tail], 1)
    np.add.at(saved, slot[tail], (x["m"][tail] - 1) * (x["words"][tail] - x["cw"][tail]))
    for at in reversed(by_level[1:]):
        deep = np.unique(slot[at])
        up = array.check[deep]
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[deep])
        np.add.at(saved, up, saved[deep])
    r, top = row[used], array.check[used] == 0
    out = {"d": x["d"][r].astype(np.int32), **{c: x[c][r] for c in ("p1", "p2", "b1", "b2")}, "conv": conv[used],
           "n_convs": members[used], "n_children": children[used], "n_leaves": leaves[used], "saved": saved[used],
           "parent": np.where(top, 0, conv[array.check[used]]), "top": top}
    return pa.table({c: pa.array(out[c], mask=top if c == "parent" else None) for c in _NODE})


def _ends_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the sorted ids of every group of equal conversations, from rows sorted by (rep, conv)."""
    rep, digest = None, None
    for batch in batches:
        done: list[tuple[int, str]] = []
        reps = batch.column(0).to_numpy()
        firsts, _ = _runs(reps, None)
        for a, b in zip(firsts, [*firsts[1:], len(reps)]):
            ids = ",".join(map(str, batch.column(1).slice(a, b - a).to_pylist()))
            if int(reps[a]) != rep:
                if rep is not None:
                    done.append((rep, digest.hexdigest()))
                rep, digest = int(reps[a]), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in done], pa.int64()),
                                          pa.array([h for _, h in done], pa.string())], ["rep", "ends"])
    if rep is not None:
        yield pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([digest.hexdigest()])], ["rep", "ends"])


def prefix_nodes(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    ids, turns = rebuilt_turns(convs, id_col, turn_col, role_col, text_col)
    turns = turns.withColumns({"g1": F.xxhash64("d", "t1", "t2"), "g2": F.xxhash64(F.lit(7), "t2", "t1", "d")})
    running = stage(_ranged(turns, F.col("conv"), F.col("d")).select("pid", "conv", "d", "t1", "t2", "w", "g1", "g2")
                    .mapInArrow(_running_task, _RUNNING_TYPES), "trie-running")
    # the last row of each part, as XOR and sum of its steps: prefix ^ before
    step = [F.bit_xor(F.col(f"l{k}").bitwiseXOR(F.col(f"b{k}"))).alias(f"x{k}") for k in (1, 2)]
    parts = running.groupBy("conv", "pid").agg(*step, F.sum("w").alias("x3"))
    before = _before(parts, y1=F.bit_xor("x1"), y2=F.bit_xor("x2"), y3=F.sum("x3"))
    none = F.lit(0).cast("long")
    fix = lambda c, y: F.col(c).bitwiseXOR(F.coalesce(y, none))
    prefixes = running.join(before, ["conv", "pid"], "left").select(
        "conv", "d", "t1", "t2", "w", fix("l1", "y1").alias("p1"), fix("l2", "y2").alias("p2"),
        fix("b1", "y1").alias("b1"), fix("b2", "y2").alias("b2"), (F.col("l3") + F.coalesce("y3", none)).alias("cw"))

    # equal sequences as one
    whole = parts.groupBy("conv").agg(F.bit_xor("x1").alias("f1"), F.bit_xor("x2").alias("f2"), F.sum("x3").alias("words"))
    length = running.groupBy("conv").agg(F.max("d").alias("len"))
    whole = stage(ids.join(whole.join(length, "conv"), "conv", "left").na.fill(0, ["f1", "f2", "words", "len"]), "trie-whole")
    seqs = stage(whole.groupBy("len", "f1", "f2", "words").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("m")), "trie-seqs")
    repeated = whole.join(seqs.filter("m > 1").select("len", "f1", "f2", "rep"), ["len", "f1", "f2"]).select("rep", "conv")
    ends = stage(repeated.repartition("rep").sortWithinPartitions("rep", "conv").mapInArrow(
        _ends_task, "rep long, ends string"), "trie-ends")
    alone = F.sha2(F.col("rep").cast("string").cast("binary"), 256)
    ends = seqs.select("rep", "len", "f1", "f2", "m").join(ends, "rep", "left").select(
        "rep", "len", "f1", "f2", F.when(F.col("m") > 1, F.col("ends")).otherwise(alone).alias("ends"))

    # shared prefixes and the uppers among them
    rows = stage(prefixes.join(seqs.select(F.col("rep").alias("conv"), "len", "words", "m"), "conv")
                 .withColumnRenamed("conv", "rep"), "trie-rows")
    shared = (rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("seqs"), F.sum(F.col("len") - F.col("d") + 1).alias("below"))
              .filter("seqs > 1").select(*KEY, "seqs", (F.col("below") > limit).alias("upper")))
    shared = stage(shared, "trie-shared")
    rows = stage(rows.join(shared.drop("seqs"), KEY, "left"), "trie-marked")
    in_trie = shared.filter("NOT upper").agg(F.coalesce(F.sum("seqs"), none)).first()[0]
    paths = rows.filter("upper IS NOT NULL").groupBy("rep").agg(
        F.max("d").alias("e"), F.count_if("upper").cast("int").alias("u"),
        F.min(F.when(~F.col("upper"), F.struct("d", "p1", "p2"))).alias("s"))
    rows = rows.join(stage(paths, "trie-paths"), "rep", "left").na.fill(0, ["e", "u"])

    # tails, and shards below the uppers
    saved = (F.col("m") - 1) * (F.col("words") - F.col("cw") + F.col("w"))
    tails = rows.filter("upper IS NULL").select(
        *KEY, "b1", "b2", F.col("rep").alias("conv"), F.col("m").alias("n_convs"),
        (F.col("len") > F.col("d")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        saved.alias("saved"), F.when(F.col("d") > F.col("e") + 1, F.col("rep")).alias("parent"), "e", "u", "len")
    bins = in_trie // limit + 1
    members = rows.filter("NOT upper").select(
        F.pmod(F.xxhash64("s"), F.lit(bins)).alias("bin"), F.col("s.p1").alias("s1"), F.col("s.p2").alias("s2"),
        "rep", "d", "t1", "t2", "w", "p1", "p2", "b1", "b2", "cw", "len", "words", "m", "e", "u")
    nodes = stage(members.groupBy("bin").applyInArrow(_trie_task, _NODE_TYPES), "trie-nodes")

    # shards, tails and uppers add to the uppers above them, and to the root
    ups = rows.filter("upper").select("rep", *KEY, "b1", "b2", "m", "w")
    uppers = stage(ups.groupBy(*KEY).agg(*[F.min(c).alias(c) for c in ("b1", "b2", "w")], F.sum("m").alias("n_convs"),
                                         F.min("rep").alias("conv")), "trie-uppers")
    own = (F.col("n_convs") - 1) * F.col("w")
    parts = (nodes.filter("top").select(F.col("conv").alias("rep"), F.col("d").alias("at"), "n_leaves", "saved")
             .unionByName(tails.filter("d = e + 1 AND e = u").select(F.col("conv").alias("rep"), F.col("d").alias("at"), "n_leaves", "saved"))
             .unionByName(uppers.select(F.col("conv").alias("rep"), F.col("d").alias("at"), none.alias("n_leaves"), own.alias("saved"))))
    total = lambda depth: [F.count_if(F.col("at") == depth + 1).alias("n_children"),
                           F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("below")]
    below = (ups.select("rep", *KEY).join(parts, "rep").filter("d < at").groupBy(*KEY).agg(*total(F.col("d"))))
    uppers = uppers.join(below, KEY).select(
        *KEY, "b1", "b2", "conv", "n_convs", "n_children", "n_leaves", (own + F.col("below")).alias("saved"))
    tree = stage(nodes.drop("top").unionByName(uppers, allowMissingColumns=True), "trie-tree")
    root = (seqs.agg(F.lit(0).alias("d"), F.min("rep").alias("conv"), F.sum("m").alias("n_convs"))
            .join(parts.agg(F.lit(0).alias("d"), *total(F.lit(0))), "d").filter("conv IS NOT NULL")
            .select("d", none.alias("p1"), none.alias("p2"), none.alias("b1"), none.alias("b2"), "conv",
                    "n_convs", "n_children", F.greatest(F.coalesce("n_leaves", none), F.lit(1)).alias("n_leaves"),
                    F.coalesce("below", none).alias("saved")))
    root = stage(root, "trie-root")

    # parents that lie in another part, and the conversations that end at a node
    joints = tree.unionByName(root, allowMissingColumns=True)
    above = joints.select((F.col("d") + 1).alias("d"), F.col("p1").alias("b1"), F.col("p2").alias("b2"), F.col("conv").alias("over"))
    over = ["d", "b1", "b2"]
    entry = joints.unionByName(tails.filter("parent IS NULL").drop("e", "u", "len"))
    entry = entry.join(above, over, "left").withColumn("parent", F.coalesce("parent", "over")).drop("over")
    inner = tails.filter("parent IS NOT NULL").drop("e", "u", "len")
    # a tail's end is its sequence's end; other prefixes are found by their key
    at_end = ends.select(F.col("len").alias("d"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), "ends")
    out = entry.unionByName(inner)
    last = out.join(at_end, KEY, "left")
    return last.select(
        F.col("conv").alias("conv_id"), F.col("d").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"))
