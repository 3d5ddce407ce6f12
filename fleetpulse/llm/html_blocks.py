"""HTML extraction by a recurrent block labeller.

A page is cut into leaf blocks: text between block-level tags, character
references decoded, white space turned into one space, trimmed. A block's
features are the tags, classes and ids on its path and its words, all hashed to
rows of an embedding table, and a few numbers (length, link share, punctuation,
place, same container as the neighbours). A bidirectional LSTM reads the blocks of the whole page in order
and labels each as article or not; article blocks are joined by line feeds.
Scripts, styles, comments and the head are no text and make no blocks, nor do
titles, templates, text areas and frames. Formulas (MathML) are inline; objects,
noscript, drawings and xmp (whose tags are text) are containers like others.

The model is written in numpy and trained by back-propagation on
``labelled_pages()``, pages made by rule in many layouts, so every block's label
is known. Embedding rows start at zero: words and classes never seen in
training have no say.

Scale: one pass inside tasks, no shuffle; the weights (about 0.3 MB, a fixed
bound) travel with the task. Pages of similar length are labelled together, at
most ``BATCH_BLOCKS`` blocks at a time unless one page has more; a page is read
whole whatever its length.

Defined results: NULL, empty and tag-only pages have the empty text; unclosed
tags, comments, scripts and styles end with the page, other unclosed elements
without blocks are passed over; bytes that are no UTF-8 count as
one replacement character; repeated rows are extracted alike; an empty table
gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

ROWS = 2048
WIDTH = 32
HIDDEN = 24
NUMBERS = 9
BATCH_BLOCKS = 20_000

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)")
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Elements that begin and end a block of text; all others stand in the line.
_BLOCK = frozenset("address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt "
                   "fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
                   "legend li listing main menu nav noframes ol optgroup option p plaintext pre search section select "
                   "summary table tbody td tfoot th thead title tr ul xmp iframe textarea template".split())
#: In the line, but worth knowing of a block that begins inside them.
_CONTEXT = frozenset("button object noscript video audio canvas map applet embed picture".split())
#: What may stand in a head; anything else ends it.
_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
_COMMENT_END = re.compile(r"--!?>")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea template iframe xmp".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table tbody thead select div section article body".split())


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple, text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def blocks(page: str) -> list[Block]:
    """The leaf blocks in page order. A path is the open elements from the top,
    each (tag, class, id and role tokens)."""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    parts: list[str] = []
    path: tuple = ()
    links = linked = 0
    pos, n = 0, len(page)
    unclosed: set[str] = set()
    in_head = False

    def flush():
        nonlocal linked
        text = " ".join(html_lib.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append(Block(path, text, linked))
        linked = 0

    def end_head():
        nonlocal in_head
        in_head = False
        for k, (t, _) in enumerate(stack):
            if t == "head":
                del stack[k:]
                break

    def add(s: str):
        nonlocal path, linked
        if s:
            if in_head and stack and stack[-1][0] == "head" and not s.isspace():
                end_head()
            if not parts:
                path = tuple(stack)
            parts.append(s)
            if links and not s.isspace():
                linked += len(s)

    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            add(page[pos:])
            break
        add(page[pos:lt])
        if page.startswith("<!--", lt):
            end = _COMMENT_END.search(page, lt + 2)     # <!--> is a whole comment
            pos = end.end() if end else n
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            pos = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE_TAG.match(page, lt)
        if not m:
            add("<")
            pos = lt + 1
            continue
        pos = m.end()
        closing, tag = bool(m[1]), m[2].lower()
        if in_head and not closing and tag not in _HEAD:
            flush()
            end_head()
        if tag not in _BLOCK and tag not in _CONTEXT and tag not in _RAW:
            if tag == "br":
                add(" ")
            elif tag == "a":
                links = max(0, links - 1) if closing else links + 1
            continue
        if tag in _BLOCK:
            flush()
            links = 0
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in _RAW and not m[3].endswith("/"):
            end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            if end and tag == "xmp":
                stack.append((tag, ()))
                add(html_lib.escape(page[pos:end.start()]))
                flush()
                stack.pop()
            if end:
                pos = end.end()
            elif tag in ("script", "style"):
                pos = n
            else:
                unclosed.add(tag)
            continue
        if tag in _VOID or m[3].endswith("/"):
            continue
        if tag == "body":  # what an unclosed head left open
            stack.clear()
        if tag in _BLOCK and stack and stack[-1][0] == "p":
            stack.pop()
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in _CLOSES.get(tag, ()):
                del stack[k:]
                break
            if stack[k][0] in _SCOPE:
                break
        names = " ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(m[3])).lower() if m[3] else ""
        stack.append((tag, tuple(re.findall(r"[a-z]+", names))))
        in_head = in_head or tag == "head"
    flush()
    return [b for b in out if not any(t == "head" for t, _ in b.path)]


def _row(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode("utf-8", "replace")) % ROWS


_row = lru_cache(maxsize=200_000)(_row)


def features(page: list[Block]) -> tuple[list[list[int]], list[list[float]], np.ndarray]:
    """Embedding rows and their weights of every block, and its numbers."""
    ids, weights = [], []
    numbers = np.zeros((len(page), NUMBERS), np.float32)
    for k, b in enumerate(page):
        path = b.path
        row = [_row("t", t) for t, _ in path] + [_row("c", c) for _, cs in path for c in cs]
        leaf = path[-1][0] if path else ""
        row += [_row("leaf", leaf), _row("pair", f"{path[-2][0] if len(path) > 1 else ''}>{leaf}"),
                _row("path", ">".join(t for t, _ in path))]
        weight = [1.0] * len(row)
        words = b.text.lower().split()
        distinct = sorted(set(words))
        row += [_row("w", w) for w in distinct]
        weight += [len(distinct) ** -0.5] * len(distinct)
        ids.append(row)
        weights.append(weight)
        end = b.text[-1]
        numbers[k] = (np.log1p(len(b.text)) / 5, np.log1p(len(words)) / 4, min(1.0, b.linked / len(b.text)), end in ".!?",
                      sum(map(b.text.count, ".,")) / len(words), len(path) / 8, (k + 1) / len(page),
                      k > 0 and page[k - 1].path[:-1] == b.path[:-1],
                      k + 1 < len(page) and page[k + 1].path[:-1] == b.path[:-1])
    return ids, weights, numbers


# --- the network -----------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _flip(x: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Every sequence in reverse, padding still at the end."""
    t = np.arange(x.shape[1])[None, :]
    at = np.where(t < lens[:, None], lens[:, None] - 1 - t, t)
    return np.take_along_axis(x, at[..., None], 1)


def _lstm(x, p, way, cache=None):
    z = x @ p["wx" + way] + p["b" + way]
    n, t_max, h = *x.shape[:2], HIDDEN
    out = np.zeros((n, t_max, h), np.float32)
    hid = np.zeros((n, h), np.float32)
    cell = np.zeros((n, h), np.float32)
    for t in range(t_max):
        a = z[:, t] + hid @ p["wh" + way]
        gate = _sigmoid(a[:, :3 * h])
        new = np.tanh(a[:, 3 * h:])
        old, before = cell, hid
        cell = gate[:, h:2 * h] * cell + gate[:, :h] * new
        squashed = np.tanh(cell)
        hid = gate[:, 2 * h:] * squashed
        out[:, t] = hid
        if cache is not None:
            cache.append((gate, new, old, squashed, before))
    return out


def _lstm_back(x, d_out, p, way, cache, g):
    n, t_max, h = *x.shape[:2], HIDDEN
    dz = np.zeros((n, t_max, 4 * h), np.float32)
    d_hid = np.zeros((n, h), np.float32)
    d_cell = np.zeros((n, h), np.float32)
    for t in range(t_max - 1, -1, -1):
        gate, new, old, squashed, before = cache[t]
        i, f, o = gate[:, :h], gate[:, h:2 * h], gate[:, 2 * h:]
        dh = d_out[:, t] + d_hid
        d_cell = d_cell + dh * o * (1 - squashed**2)
        a = np.concatenate([d_cell * new * i * (1 - i), d_cell * old * f * (1 - f), dh * squashed * o * (1 - o),
                            d_cell * i * (1 - new**2)], 1)
        dz[:, t] = a
        g["wh" + way] += before.T @ a
        d_hid = a @ p["wh" + way].T
        d_cell = d_cell * f
    g["wx" + way] += x.reshape(-1, x.shape[2]).T @ dz.reshape(-1, 4 * h)
    g["b" + way] += dz.sum((0, 1))
    return dz @ p["wx" + way].T


def _pack(pages: list[tuple]) -> tuple:
    """Pages' features as flat rows with their place, padded numbers, lengths."""
    lens = np.array([len(p[0]) for p in pages])
    t_max = int(lens.max())
    place, rows, weights = [], [], []
    numbers = np.zeros((len(pages), t_max, NUMBERS), np.float32)
    for k, (ids, ws, nums) in enumerate(pages):
        numbers[k, :len(ids)] = nums
        for t, (r, w) in enumerate(zip(ids, ws)):
            rows += r
            weights += w
            place += [k * t_max + t] * len(r)
    return np.array(place), np.array(rows), np.array(weights, np.float32), numbers, lens


def _embed(p, packed):
    place, rows, weights, numbers, lens = packed
    n, t_max = numbers.shape[:2]
    flat = np.zeros((n * t_max, WIDTH), np.float32)
    if len(place):
        start = np.flatnonzero(np.diff(place, prepend=-1))
        flat[place[start]] = np.add.reduceat(p["emb"][rows] * weights[:, None], start, 0)
    return np.tanh(flat.reshape(n, t_max, WIDTH) + numbers @ p["num"] + p["bias"])


def _forward(p, packed, caches=None):
    lens = packed[4]
    x = _embed(p, packed)
    fwd = _lstm(x, p, "f", None if caches is None else caches[0])
    back_in = _flip(x, lens)
    bwd = _flip(_lstm(back_in, p, "b", None if caches is None else caches[1]), lens)
    top = np.concatenate([fwd, bwd, x], 2)
    return x, back_in, top, (top @ p["out"]).squeeze(2) + p["out_bias"]


def label(p: dict, pages: list[tuple]) -> list[np.ndarray]:
    """Article or not, for every block of every page (features of each)."""
    order = sorted((k for k in range(len(pages)) if len(pages[k][0])), key=lambda k: len(pages[k][0]))
    out = [np.zeros(0, bool)] * len(pages)
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b - a + 1) * len(pages[order[b]][0]) <= BATCH_BLOCKS:
            b += 1
        scores = _forward(p, _pack([pages[k] for k in order[a:b]]))[3]
        for k, s in zip(order[a:b], scores):
            out[k] = s[:len(pages[k][0])] > 0
        a = b
    return out


def train(table: list[tuple[str, list[bool]]], epochs: int = 16, batch: int = 16, rate: float = 0.015, seed: int = 2) -> dict:
    rng = np.random.default_rng(seed)
    init = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
    h = HIDDEN
    p = {"emb": np.zeros((ROWS, WIDTH), np.float32), "num": init(NUMBERS, WIDTH), "bias": np.zeros(WIDTH, np.float32),
         "out": init(2 * h + WIDTH, 1), "out_bias": np.zeros(1, np.float32)}
    for way in "fb":
        p |= {"wx" + way: init(WIDTH, 4 * h), "wh" + way: init(h, 4 * h), "b" + way: np.zeros(4 * h, np.float32)}
        p["b" + way][h:2 * h] = 1
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    # a tenth of the rows is left out at random, so the layout around a
    # block has to carry the label as well
    pages = [(features(blocks(page)), np.array(y, np.float32)) for page, y in table]
    pages.sort(key=lambda x: len(x[1]))
    groups = [pages[k:k + batch] for k in range(0, len(pages), batch)]
    step, total = 0, epochs * len(groups) + 1
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            step += 1
            place, rows, weights, numbers, lens = _pack([x for x, _ in groups[k]])
            weights = weights * (rng.random(len(weights)) > 0.1) / np.float32(0.9)
            packed = (place, rows, weights.astype(np.float32), numbers, lens)
            caches: tuple[list, list] = ([], [])
            x, back_in, top, score = _forward(p, packed, caches)
            mask = np.arange(score.shape[1])[None, :] < lens[:, None]
            y = np.zeros(score.shape, np.float32)
            for r, (_, gold) in enumerate(groups[k]):
                y[r, :len(gold)] = gold
            d = ((_sigmoid(score) - y) * mask / mask.sum()).astype(np.float32)
            g = {q: np.zeros_like(z) for q, z in p.items()}
            g["out"] = (top * d[..., None]).sum((0, 1))[:, None]
            g["out_bias"][0] = d.sum()
            d_top = d[..., None] * p["out"][:, 0]
            dx = _lstm_back(x, d_top[..., :h], p, "f", caches[0], g) + d_top[..., 2 * h:]
            dx = dx + _flip(_lstm_back(back_in, _flip(d_top[..., h:2 * h], lens), p, "b", caches[1], g), lens)
            dx = (dx * (1 - x**2) * mask[..., None]).astype(np.float32)
            g["bias"] = dx.sum((0, 1))
            g["num"] = numbers.reshape(-1, NUMBERS).T @ dx.reshape(-1, WIDTH)
            np.add.at(g["emb"], rows, dx.reshape(-1, WIDTH)[place] * packed[2][:, None])
            for q in p:
                m[q] = 0.9 * m[q] + 0.1 * g[q]
                v[q] = 0.999 * v[q] + 0.001 * g[q] * g[q]
                p[q] = (p[q] - rate * (1 - step / total) * (m[q] / (1 - 0.9**step)) / (np.sqrt(v[q] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


# --- the labelled pages ----------------------------------------------------

_MAIN = ["<article>", "<main><article>", '<article class="post">', '<div class="content">', '<div class="post entry">',
         '<div class="entry-content">', '<section class="article-body">', '<div id="main">', '<main>',
         '<div id="content" class="text">', '<div class="story"><div>', '<div role="main">', "<article><div>", "<div>"]
_CUES = {"nav": "home about news contact menu login products".split(), "ad": "sponsored offer buy now sale advertisement".split(),
         "notice": "cookies accept privacy policy we use".split(), "comment": "comment reply says wrote ago".split(),
         "footer": "&copy; rights reserved imprint terms privacy".split(), "side": "related popular tags archive recent".split(),
         "form": "search subscribe email name send submit".split(), "header": "welcome site logo tagline".split()}


def labelled_pages(pages: int = 600, seed: int = 4) -> list[tuple[str, list[bool]]]:
    """(page, label of every block): pages in mixed layouts, with and without
    telling names, article blocks among menus, notices, adverts, sidebars,
    forms, comments and footers. Texts are made-up words on both sides."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chance = lambda q: rng.random() < q
    syllables = "an be che de er fi go hi in ka lo mi nu or pa qui re sa ti un vo wa ze éa ü ñó".split()
    word = lambda: "".join(pick(syllables) for _ in range(int(rng.integers(1, 4))))

    def words(lo, hi):
        return " ".join(word() for _ in range(int(rng.integers(lo, hi + 1))))

    def sentence(lo=3, hi=25):
        s = words(lo, hi)
        return s[:1].upper() + s[1:] + pick([".", ".", ".", "!", "?", ""])

    def para():
        odd = rng.random()
        if odd < 0.05:
            return " ".join([word()] * int(rng.integers(5, 120)))
        if odd < 0.1:
            return " | ".join(word() for _ in range(int(rng.integers(5, 60))))
        if odd < 0.13:
            return words(5, 40).upper().replace(" ", "!! ")
        return " ".join(sentence() for _ in range(int(rng.integers(1, 7)))) + pick(["", "", " &amp; " + word(), " %%% ***"])

    out = []
    for _ in range(pages):
        html: list[str] = []
        labels: list[bool] = []
        plain = chance(0.12)

        def put(text, main, open_="", close=""):
            html.append(f"{open_}{text}{close}")
            labels.append(main)

        def cue(kind):
            return f"{pick(_CUES[kind])} " if chance(0.3) else ""

        def box(tags, names, fill):
            tag = "div" if plain else pick(tags)
            name = "" if plain or (tag != "div" and chance(0.5)) else f' {pick(["class", "class", "id"])}="{pick(names)}"'
            html.append(f"<{tag}{name}>")
            fill()
            html.append(f"</{tag}>")

        def listing(kind, n):
            def fill():
                html.append("<ul>")
                for _ in range(n):
                    w = word()
                    put(cue(kind) + words(1, 4), False, f'<li><a href="/{w}">', "</a></li>")
                html.append("</ul>")
            return fill

        def lines(kind, n, lo=2, hi=20):
            def fill():
                if n == 1 and chance(0.6):
                    put(cue(kind) + sentence(lo, hi), False)
                    return
                for _ in range(n):
                    put(cue(kind) + sentence(lo, hi), False, *pick([("<p>", "</p>"), ("<div>", "</div>"), ("<span>", "</span><hr>")]))
            return fill

        def form():
            html.append("<form action='/s'>")
            for _ in range(int(rng.integers(1, 4))):
                put(cue("form") + words(1, 5), False, *pick([("<p>", "</p>"), ("<fieldset>", "</fieldset>"), ("<div><label>", "</label></div>")]))
            put(cue("form") + word(), False, "<button>", "</button></form>")

        ad = lambda: box(["div", "aside", "section"], ["ad", "ads", "advert", "sponsored", "promo", "banner ad", "ad-slot"], lines("ad", 1))
        notice = lambda: box(["div", "section", "aside"], ["notice", "cookie", "cookie-banner", "alert", "gdpr consent", "newsletter", "popup message"], lines("notice", int(rng.integers(1, 3))))
        nav = lambda: box(["nav", "nav", "div"], ["nav", "menu", "navbar", "breadcrumb", "topnav navigation"], listing("nav", int(rng.integers(2, 9))))
        header = lambda: box(["header", "header", "div"], ["header", "masthead", "site-header", "top branding"], lines("header", int(rng.integers(1, 3)), 1, 8))
        side = lambda: box(["aside", "aside", "div"], ["sidebar", "side widget", "related", "trending", "recommended posts"], pick([listing("side", 4), lines("side", 3), listing("side", 2)]))
        footer = lambda: box(["footer", "footer", "div"], ["footer", "site-footer", "bottom copyright"], pick([lines("footer", 1), lines("footer", 2), listing("footer", 3)]))

        def comments():
            def fill():
                if chance(0.5):
                    put(pick(["Comments", words(1, 3), "3 comments"]), False, "<h3>", "</h3>")
                for _ in range(int(rng.integers(1, 6))):
                    put(cue("comment") + para(), False, *pick([('<div class="comment"><p>', "</p></div>"), ("<li><p>", "</p></li>"),
                                                               ('<p class="comment">', "</p>"), ("<div>", "</div>"), ("<article class='comment'><p>", "</p></article>")]))
                if chance(0.3):
                    form()
            box(["section", "div", "ol"], ["comments", "comment-list", "responses", "discussion replies", "disqus thread"], fill)

        html.append(f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{words(2, 8)}</title>'
                    f'<style>p{{margin:0}}</style><script>var a="</p>";</script></head><body>')
        wrap = chance(0.3)
        if wrap:
            html.append('<div class="%s">' % pick(["page", "wrapper", "container", word()]))
        for f, q in ((notice, 0.25), (header, 0.45), (nav, 0.75), (ad, 0.45), (form, 0.15), (side, 0.15)):
            if chance(q):
                f()
        opening = "<div>" if plain else pick(_MAIN)
        html.append(opening)
        if chance(0.85):
            t = sentence(1, 16)
            put(t, True, "<h1>", "</h1>")
            if chance(0.4):
                put(t, True, "<p><b>", "<br>")
        # from one short paragraph to long articles
        for _ in range(int(pick([1, 1, 2, 3, 4, 6, 9, 14, 25]))):
            kind = rng.random()
            if kind < 0.72:
                put(pick([para(), para(), sentence(1, 4)]), True, "<p>", pick(["</p>", "</p>", ""]))
            elif kind < 0.79:
                put(words(1, 6), True, "<h2>", "</h2>")
            elif kind < 0.86:
                html.append("<ul>")
                for _ in range(int(rng.integers(2, 5))):
                    put(sentence(), True, "<li>", "</li>")
                html.append("</ul>")
            elif kind < 0.9:
                put(para(), True, "<blockquote>", "</blockquote>")
            elif kind < 0.93:
                put(para(), True, "<div>", "</div>")
            elif kind < 0.96:
                put(words(2, 8), True, "<table><tr><td>", "</td></tr></table>")
            elif kind < 0.985:
                ad()
            else:
                pick([notice, side, form])()
        html += ["</%s>" % t for t in reversed(re.findall(r"<(\w+)", opening))]
        for f, q in ((ad, 0.2), (side, 0.3), (comments, 0.4), (form, 0.15), (notice, 0.15), (footer, 0.8)):
            if chance(q):
                f()
        html.append("</div></body></html>" if wrap else "</body></html>")
        out.append(("".join(html), labels))
    return out


@lru_cache(maxsize=1)
def default_model() -> dict:
    return train(labelled_pages())


# --- extraction ------------------------------------------------------------

def main_texts(model: dict, pages: list[str | None]) -> list[str]:
    cut = [blocks(p) if p else [] for p in pages]
    flags = label(model, [features(b) for b in cut])
    return ["\n".join(x.text for x, keep in zip(b, f) if keep) for b, f in zip(cut, flags)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            model: dict | None = None) -> DataFrame:
    """(page_id, url, text): the article text of every page."""
    model = model or default_model()
    kept = [pages.schema[id_col].dataType, pages.schema[url_col].dataType]
    arrow = pa.schema([("page_id", to_arrow_type(kept[0])), ("url", to_arrow_type(kept[1])), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            for a in range(0, batch.num_rows, 500):
                part = batch.column(2).slice(a, 500).to_pylist()
                texts += main_texts(model, [None if t is None else t.decode("utf-8", "replace") for t in part])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], schema=arrow)

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("binary").alias("html"))
    return rows.mapInArrow(run, f"page_id {kept[0].simpleString()}, url {kept[1].simpleString()}, text string")
