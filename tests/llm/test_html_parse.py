"""The blocks of the labeller against a walk with the standard library's parser."""

import random
from html.parser import HTMLParser

import pytest

from fleetpulse.llm import html_blocks as B


class Walk(HTMLParser):
    """Texts between block-level tags, without raw elements and the head."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts, self.line, self.skip, self.head = [], "", 0, False

    def cut(self):
        if self.line.split():
            self.texts.append(" ".join(self.line.split()))
        self.line = ""

    def handle_starttag(self, tag, attrs):
        if self.head and tag not in B._HEAD:
            self.head = False
        if tag in B._RAW:
            self.skip += 1
        self.head |= tag == "head"
        if tag in B._BLOCK:
            self.cut()
        if tag == "br":
            self.line += " "

    def handle_endtag(self, tag):
        if tag in B._RAW:
            self.skip -= 1
        if tag == "head":
            self.head = False
        if tag in B._BLOCK:
            self.cut()

    def handle_data(self, data):
        if not self.skip and data.strip():
            self.head = False
        if not self.skip and not self.head:
            self.line += data


def page(rng):
    out = [rng.choice(["<html><head><title>t t</title><meta a=1>", "<head><style>p {x}</style></head><body>", "", "<!doctype html>"])]
    def inside(depth):
        for _ in range(rng.randrange(1, 5)):
            kind = rng.randrange(9)
            if kind < 3 and depth < 6:
                tag = rng.choice(["div", "section", "ul", "article", "table", "button", "x-card", "noscript"])
                out.append(f'<{tag} class="c{rng.randrange(3)}">')
                inside(depth + 1)
                out.append(f"</{tag}>")
            elif kind < 6:
                out.append(f"<p>{rng.choice(['one two', 'a &amp; b', 'x<b>y</b>z', 'k<ruby>k<rt>r</rt></ruby>', 'l<br>m'])}")
                out.append(rng.choice(["", "</p>", "<script>if (a < b) {}</script> more</p>", "<!-- c --> on</p>", "<!-->tail</p>"]))
            else:
                out.append(rng.choice([" loose ", "<svg><text>s</text></svg>", "<span>in <i>line</i></span>", "<hr>", "<img src=x>", "<h2>Head &#233;</h2>"]))
    inside(0)
    return "".join(out)


@pytest.mark.parametrize("seed", range(5))
def test_same_blocks_as_a_plain_walk(seed):
    rng = random.Random(seed)
    for _ in range(300):
        text = page(rng)
        walk = Walk()
        walk.feed(text.replace("<!-->", "<!---->"))
        walk.close()
        walk.cut()
        assert [b.text for b in B.blocks(text)] == walk.texts, text


def texts(html):
    return [b.text for b in B.blocks(html)]


def test_an_open_head_loses_nothing():
    assert texts("<html><head><title>x</title><p>Real text</p><p>More") == ["Real text", "More"]
    assert texts("<head><meta a>Loose text<p>x") == ["Loose text", "x"]
    assert texts("<head><noscript><link></noscript><script>1</script><span>first</span></head>") == ["first"]


def test_what_stands_in_the_line_splits_no_paragraph():
    assert texts("<p>A <ruby>kan<rt>ji</rt></ruby> word<script>x<1</script> after <x-y>own</x-y> <svg><text>t</text></svg> end</p>") == [
        "A kanji word after own t end"]
    assert texts("<p>a<meta x> b<link y> <button>c</button> <acronym>d</acronym> <nobr>e</nobr></p>") == ["a b c d e"]


def test_short_comments():
    assert texts("<p>one</p><!--><p>two</p><!---><p>three</p><!-- c --!><p>four") == ["one", "two", "three", "four"]


def test_deep_paths_are_features_whole():
    deep = B.blocks("".join(f'<div class="k{chr(97 + i % 26)}{chr(97 + i // 26)}">' for i in range(60)) + "text")
    rows, weights, _ = B.features(deep)
    assert len(deep[0].path) == 60 and len(rows[0]) >= 120 and len(rows[0]) == len(weights[0])
