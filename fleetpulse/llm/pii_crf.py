"""Personal data: exact patterns plus a linear-chain conditional random field.

Base spans come from four patterns (email, ip, card, phone), leftmost and
non-overlapping per kind; matches that fail their test are dropped without
another try. The field adds spans the patterns miss (such as phone numbers
without a plus sign or cards with dots): tokens are runs of digits, runs of
letters and single other characters; a token's features are the shapes of the
tokens up to three places around it; labels are O and begin/inside of each
kind. It is trained by maximum likelihood on ``labelled_table()``, a small
table made by rule, and decoded by Viterbi in numpy batches.

Every kind holds a digit or an @ near each of its tokens, so the label lattice
allows only O on tokens more than ``REACH`` tokens away from one; stretches
between are decoded in full length. A decoded span counts if it overlaps no
base span and passes its kind's test (digits, parts, check digit).

Scale: one pass over the texts inside tasks, no shuffle; the weights (about
5,000 numbers, a fixed bound) travel with the task. Only stretches near digits
and @ are held as arrays, at most ``BATCH_TOKENS`` at a time unless one stretch
is longer.

Defined results: NULL and empty texts have no spans; bytes that are no UTF-8
count as one replacement character; repeated rows are searched alike; an empty
table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)                       # O, then begin and inside of each kind
REACH = 8
BATCH_TOKENS = 200_000
OFFSETS = (-3, -2, -1, 0, 1, 2, 3)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z\x80-\U0010ffff]+|[^ \t\n\x0b\x0c\r]")
_TRIGGER = re.compile("[0-9@]")


# --- base patterns ---------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Grown from every @: the local part back to the end of the last match,
    the domain forward. Linear, where plain backtracking is not."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if _ip_ok(m[0])]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in s.split("."))


def _plausible(kind: str, s: str) -> bool:
    d = _digits(s)
    if kind == "email":
        return bool(re.fullmatch(r"[^@]*\w[^@]*@[^@]*\w\.\w[^@]*", s))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", s)) and _ip_ok(s)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 7 <= len(d) <= 15


# --- shapes ----------------------------------------------------------------

_MARKS = "@.-+()_%:=/,'\"#&"
_SHAPES = 2 * (5 + 12 + len(_MARKS) + 1) + 1       # with and without a space before; 0 is outside


def _shape(token: str, spaced: bool) -> int:
    c = token[0]
    if "0" <= c <= "9":
        n = len(token)
        k = 5 + (n if n <= 4 else 5 if n <= 6 else 6 if n <= 9 else 7 if n <= 12 else 8 if n <= 15 else
                 9 if n == 16 else 10 if n <= 19 else 11)
    elif c in _MARKS:
        k = 17 + _MARKS.index(c)
    elif len(token) == 1 and not c.isalpha():
        k = 17 + len(_MARKS)
    else:
        k = 0 if token.islower() else 1 if token.istitle() else 2 if token.isupper() else 3 if len(token) <= 12 else 4
    return 1 + 2 * k + spaced


def stretches(text: str) -> list[tuple[np.ndarray, list[tuple[int, int]]]]:
    """(shapes, character spans) of every run of tokens near a digit or @; the
    shapes have three outside or neighbouring tokens on each side."""
    if not _TRIGGER.search(text):
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    near = np.zeros(len(tokens) + 1, np.int64)
    shapes = np.zeros(len(tokens) + 6, np.int64)
    end = -1
    for k, (a, b) in enumerate(tokens):
        shapes[k + 3] = _shape(text[a:b], a != end)
        end = b
        if text[a] == "@" or "0" <= text[a] <= "9":
            near[max(0, k - REACH)] += 1
            near[min(len(tokens), k + REACH + 1)] -= 1
    on = np.cumsum(near)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return [(shapes[a:b + 6], tokens[a:b]) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


# --- the field -------------------------------------------------------------

def _pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Window shapes (sequence, token, offset) padded at the end, and lengths."""
    lens = np.array([len(s) - 6 for s in seqs])
    out = np.zeros((len(seqs), int(lens.max()), len(OFFSETS)), np.int64)
    for k, s in enumerate(seqs):
        for o in range(len(OFFSETS)):
            out[k, :lens[k], o] = s[o:o + lens[k]]
    return out, lens


def _scores(weights: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    return sum(weights[o, shapes[..., o]] for o in range(len(OFFSETS)))


def viterbi(model: dict, seqs: list[np.ndarray]) -> list[np.ndarray]:
    """The best tags of every sequence, all sequences of a batch in step."""
    shapes, lens = _pad(seqs)
    e = _scores(model["weights"], shapes)
    n, t_max = shapes.shape[:2]
    back = np.zeros((n, t_max, TAGS), np.int8)
    best = model["start"] + e[:, 0]
    final = best.copy()
    for t in range(1, t_max):
        s = best[:, :, None] + model["trans"]
        back[:, t] = s.argmax(1)
        best = s.max(1) + e[:, t]
        final[lens > t] = best[lens > t]
    tag = (final + model["stop"]).argmax(1)
    tags = np.zeros((n, t_max), np.int64)
    for t in range(t_max - 1, -1, -1):
        here = lens > t
        tags[here, t] = tag[here]
        if t:
            tag = np.where(here, back[np.arange(n), t, tag], tag)
    return [tags[k, :lens[k]] for k in range(n)]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def train(table: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = 70, rate: float = 0.15,
          l2: float = 2e-4, seed: int = 3) -> dict:
    """Maximum likelihood by forward-backward and Adam."""
    seqs, gold = [], []
    for text, spans in table:
        for shapes, tokens in stretches(text):
            tags = np.zeros(len(tokens), np.int64)
            for kind, a, b in spans:
                inside = [k for k, (x, y) in enumerate(tokens) if a <= x and y <= b]
                for k in inside:
                    tags[k] = 1 + 2 * KINDS.index(kind) + (k != inside[0])
            seqs.append(shapes)
            gold.append(tags)
    shapes, lens = _pad(seqs)
    n, t_max = shapes.shape[:2]
    mask = np.arange(t_max)[None, :] < lens[:, None]
    y = np.zeros((n, t_max), np.int64)
    for k, g in enumerate(gold):
        y[k, :len(g)] = g
    last = y[np.arange(n), lens - 1]
    rng = np.random.default_rng(seed)
    p = {"weights": rng.normal(0, 0.01, (len(OFFSETS), _SHAPES, TAGS)), "trans": np.zeros((TAGS, TAGS)),
         "start": np.zeros(TAGS), "stop": np.zeros(TAGS)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    one = np.eye(TAGS)
    flat = [shapes[..., o][mask] for o in range(len(OFFSETS))]
    for epoch in range(1, epochs + 1):
        e = _scores(p["weights"], shapes)
        fwd = np.zeros((n, t_max, TAGS))
        bwd = np.zeros((n, t_max, TAGS))
        fwd[:, 0] = p["start"] + e[:, 0]
        for t in range(1, t_max):
            fwd[:, t] = _lse(fwd[:, t - 1, :, None] + p["trans"], 1) + e[:, t]
        bwd[:, t_max - 1] = p["stop"]
        for t in range(t_max - 2, -1, -1):
            ends = (lens - 1 == t)[:, None]
            bwd[:, t] = np.where(ends, p["stop"], _lse(p["trans"][None] + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2))
        z = _lse(fwd[np.arange(n), lens - 1] + p["stop"], 1)
        prob = np.exp(fwd + bwd - z[:, None, None]) * mask[..., None]
        g = {"start": prob[:, 0].sum(0) - one[y[:, 0]].sum(0),
             "stop": prob[np.arange(n), lens - 1].sum(0) - one[last].sum(0), "trans": np.zeros((TAGS, TAGS))}
        for t in range(1, t_max):
            on = lens > t
            pair = np.exp(fwd[on, t - 1, :, None] + p["trans"] + (e[on, t] + bwd[on, t])[:, None, :] - z[on, None, None])
            g["trans"] += pair.sum(0)
            np.add.at(g["trans"], (y[on, t - 1], y[on, t]), -1)
        diff = (prob - one[y] * mask[..., None])[mask]
        g["weights"] = np.stack([np.stack([np.bincount(flat[o], diff[:, k], _SHAPES) for k in range(TAGS)], 1)
                                 for o in range(len(OFFSETS))])
        for k in p:
            grad = g[k] / n + l2 * p[k]
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad * grad
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**epoch)) / (np.sqrt(v[k] / (1 - 0.999**epoch)) + 1e-8)
    return p


# --- the labelled table ----------------------------------------------------

_FRAMES = ["{}", "Call {} today.", "reach me at {}, please", "write to {} or", "Card: {}.", "paid with {} on Monday",
           "the host {} answered", "from {} to the gate", "ththe onre {} inthe, ander", "Er und {} die", "({})",
           "tel. {} (office)", "Kontakt: {}", "une {} des", "und\n{}\nder"]
_PLAIN = ["Version {0}.{1}", "licensed under CC BY-NC {0}.0.", "GNU General Public License, version {0}.", "in {2}-0{0}-1{1}",
          "at {0}:{3}", "pages {4} to {5}", "costs ${4}.{3}", "{4} people in {2}", "see #{5}, @team", "token = \"{6}\"",
          "password={6}", "AKIA{7}", "id {8}", "{0}%", "ratio {1}/{0}", "{2}/{4}/{3}", "v{0}.{1}.{4}", "chapter {0}, line {4}",
          "on {3}.{0}.{2}", "x = {4}.{5}", "the {0}th of {1}", "sha {6}", "no. {5}", "({0}) and ({1})", "Apache License, Version {0}.{1}."]


def labelled_table(rows: int = 500, seed: int = 1) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, spans): sentences around made-up data of the four kinds in many
    notations, and sentences with numbers that are none."""
    rng = np.random.default_rng(seed)
    num = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("abdehinorst"), rng.integers(2, 9)))
    prose = lambda: " ".join(word() for _ in range(rng.integers(0, 9)))
    pick = lambda xs: xs[rng.integers(len(xs))]

    def card():
        d = pick("3456") + num(int(rng.integers(14, 17)))
        check = next(c for c in "0123456789" if luhn(d + c))
        d += check
        sep = pick(["", " ", "-", "."])
        return sep.join(d[k:k + 4] for k in range(0, len(d), 4))

    def datum(kind):
        if kind == "email":
            return f"{word()}{pick(['', '.' + word(), '.' + num(2), '_' + word(), '+' + word()])}@{word()}{pick(['', num(1), '-' + word()])}.{pick(['example.com', 'org', 'net', 'co.uk', 'de'])}"
        if kind == "ip":
            return ".".join(str(rng.integers(0, 256)) for _ in range(4))
        if kind == "card":
            return card()
        a, b, c = num(3), num(3), num(4)
        return pick([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}", f"+{num(2)} {a} {b}{c}",
                     f"+{num(2)} {num(2)} {num(4)} {num(4)}", f"{a}.{b}.{c}", f"+{num(2)}-{a}-{b}-{c}"])

    out = []
    for k in range(rows):
        spans: list[tuple[str, int, int]] = []
        text = ""
        for _ in range(int(rng.integers(1, 3))):
            text += prose() + " "
            if k % 2:
                kind = pick(KINDS)
                before, after = pick(_FRAMES).split("{}")
                value = datum(kind)
                spans.append((kind, len(text) + len(before), len(text) + len(before) + len(value)))
                text += before + value + after + " "
            else:
                text += pick(_PLAIN).format(num(1), num(1), "20" + num(2), num(2), num(int(rng.integers(2, 4))), num(int(rng.integers(4, 7))),
                                            "".join(rng.choice(list("0123456789abcdef"), 24)),
                                            "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), 16)),
                                            num(int(rng.integers(7, 25)))) + " "
        out.append((text + prose(), spans))
    return out


@lru_cache(maxsize=1)
def default_model() -> dict:
    return train(labelled_table())


# --- search ----------------------------------------------------------------

def _decode(model: dict, found: list[tuple[int, np.ndarray, list]]) -> Iterator[tuple[int, str, int, int]]:
    """(text, kind, start, end) of the decoded spans of stretches."""
    found = sorted(found, key=lambda x: len(x[1]))
    a = 0
    while a < len(found):
        b, widest = a, 0
        while b < len(found) and (b == a or (b - a + 1) * len(found[b][1]) <= BATCH_TOKENS):
            widest, b = len(found[b][1]), b + 1
        for (row, _, tokens), tags in zip(found[a:b], viterbi(model, [x[1] for x in found[a:b]])):
            k = 0
            while k < len(tags):
                if tags[k] == 0:
                    k += 1
                    continue
                kind = int(tags[k] - 1) // 2
                end = k + 1
                while end < len(tags) and tags[end] == 2 + 2 * kind:
                    end += 1
                yield row, KINDS[kind], tokens[k][0], tokens[end - 1][1]
                k = end
        a = b


def search(texts: list[str | None], model: dict) -> list[list[tuple[str, int, int, bool]]]:
    """Per text: (kind, start, end, base) by kind as listed, then start."""
    out: list[list[tuple[str, int, int, bool]]] = []
    found = []
    for row, text in enumerate(texts):
        spans = base_spans(text) if text else []
        out.append([(*s, True) for s in spans])
        found += [(row, *s) for s in stretches(text)] if text else []
    taken = [sorted((a, b) for _, a, b, _ in spans) for spans in out]
    for row, kind, a, b in _decode(model, found):
        if _plausible(kind, texts[row][a:b]) and not any(x < b and a < y for x, y in taken[row]):
            out[row].append((kind, a, b, False))
    rank = {k: i for i, k in enumerate(KINDS)}
    return [sorted(spans, key=lambda s: (rank[s[0]], s[1], s[2])) for spans in out]


_SPAN = "struct<kind: string, start: long, end: long, base: boolean>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None) -> DataFrame:
    """(doc_id, spans): all spans in code points, end exclusive; ``base`` tells
    the patterns' from the field's."""
    model = model or default_model()
    id_type = docs.schema[id_col].dataType
    arrow = pa.schema([("doc_id", to_arrow_type(id_type)), ("spans", pa.list_(pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            spans = [[dict(zip(("kind", "start", "end", "base"), s)) for s in row] for row in search(texts, model)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, arrow.field(1).type)], schema=arrow)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, spans array<{_SPAN}>")
