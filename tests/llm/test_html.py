"""Blocks of odd pages, the field beside brute force, and extraction beside pages it has not seen."""

from __future__ import annotations

import itertools
from html.parser import HTMLParser

import numpy as np
import pytest

from textloom.llm import html_text as ht
from textloom.llm.dom_blocks import leaf_blocks
from textloom.llm.labelled_pages import MARK, labelled_pages
from textloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return ht.train(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def texts(page):
    return [b.text for b in leaf_blocks(page)]


def path_of(block):
    out, at = [], block.path
    while at is not None:
        out.append(at.element.tag)
        at = at.above
    return out[::-1]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, []),
        ("", []),
        ("   \n ", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a<b>b</b>c<br>d</p>", ["abc d"]),
        ("<p>one<p>two<div>three</div>four", ["one", "two", "three", "four"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p>&lt;b&gt; &amp;amp; &eacute;&#233;&nbsp;x&copy</p>", ["<b> &amp; éé x©"]),
        ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no", ["yes"]),
        ("<script>var a='</p><p>no'</script><style>p{}</style><p>yes</p>", ["yes"]),
        ("<p>a</p><script>no", ["a"]),
        ("<title>no</title><p title='a > b'>yes</p>", ["yes"]),
        ("<p>1 < 2 and 3 <4</p>", ["1 < 2 and 3 <4"]),
        ("<p>a</p><p class='x", ["a"]),
        ("<p class=it's>a</p>", ["a"]),
        ("</p></div></b>a</table>", ["a"]),
        ("<![CDATA[no]]><?php no ?><!DOCTYPE no><p>a</p>", ["a"]),
        ("<P>A</P><DIV>B</DIV>", ["A", "B"]),
        ("a<wbr>b<img src=x>c", ["abc"]),
        ("<b><p>x</b>y</p>", ["xy"]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


def test_paths_and_links():
    page = '<html><body><div class="site-nav mainMenu" id=top><a href="/x">one</a> two</div><p><a>x</a></p><div><table><td></div>y</table>z'
    first, second, third, fourth = leaf_blocks(page)
    assert path_of(first) == ["html", "body", "div"] and first.path.element.names == ("site", "nav", "main", "menu", "top")
    assert first.linked == 3 and second.linked == 1
    assert path_of(third)[-2:] == ["table", "td"] and path_of(fourth)[-1] == "div"


def test_long_and_deep_pages_take_one_pass():
    assert len(texts("<div>x" * 50_000)) == 50_000
    assert texts("<p '" * 50_000) == [] and texts("<!-- a --" * 50_000) == []
    assert texts("<p>" + "word " * 200_000) == [("word " * 200_000).strip()]


def test_viterbi_beside_all_taggings():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = rng.integers(1, 7)
        e, move, start = rng.normal(0, 2, n), rng.normal(0, 1, (2, 2)), rng.normal()

        def score(tags):
            return start * tags[0] + sum(x for x, t in zip(e, tags) if t) + sum(move[a, b] for a, b in zip(tags, tags[1:]))

        best = max(itertools.product((0, 1), repeat=int(n)), key=score)
        assert tuple(ht.viterbi(e.tolist(), move, start)) == best
    assert ht.viterbi([0.0, 0.0, 0.0], np.zeros((2, 2)), 0.0) == [0, 0, 0]


def test_expectations_beside_all_taggings():
    rng = np.random.default_rng(4)
    lengths = np.array([1, 3, 5])
    e, move, start = rng.normal(0, 1, (3, 5)), rng.normal(0, 1, (2, 2)), 0.3
    total, one, pairs = ht.expectations(e, lengths, move, start)
    want_pairs = np.zeros((2, 2))
    for i, n in enumerate(lengths.tolist()):
        weight = {
            tags: np.exp(start * tags[0] + e[i, :n] @ np.array(tags) + sum(move[a, b] for a, b in zip(tags, tags[1:])))
            for tags in itertools.product((0, 1), repeat=n)
        }
        z = sum(weight.values())
        assert np.isclose(total[i], np.log(z))
        want = sum(w / z * np.array(tags) for tags, w in weight.items())
        assert np.allclose(one[i, :n], want) and not one[i, n:].any()
        for tags, w in weight.items():
            for a, b in zip(tags, tags[1:]):
                want_pairs[a, b] += w / z
    assert np.allclose(pairs, want_pairs)


def test_held_out_layouts(model):
    """Blocks of 300 generated pages of another seed."""
    reader, right, blocks, whole = ht.Reader(model), 0, 0, 0
    for page in labelled_pages(300, 77):
        found, labels = ht.labels_of_layout(page)
        tags = ht.viterbi(reader.emissions(found), model.move, model.start)
        same = [a == b for a, b in zip(tags, labels)]
        right, blocks, whole = right + sum(same), blocks + len(same), whole + all(same)
    assert right >= 0.99 * blocks and whole >= 0.85 * 300


HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"
PAGES = {  # written by hand; other names of parts than the layouts have
    "blog": (
        HEAD + '<div class="cookie-consent-bar"><p>We and our partners use cookies.</p><button>OK</button></div>'
        '<div id="site-nav"><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></div>'
        '<div class="blog-post-content"><h1>How bees fly</h1><p>Bees beat their wings <i>very</i> fast, as we know.</p>'
        "<p>They do so &amp; more.</p><ul><li>Short strokes.</li><li>Twisting wings.</li></ul></div>"
        '<div id="reader-comments"><h3>2 comments</h3><div class="comment-body"><p>I did not know that, thank you for it.</p></div></div>'
        '<div id="page-footer"><p>© 2021 Bee Blog. All rights reserved.</p></div></body></html>',
        "How bees fly\nBees beat their wings very fast, as we know.\nThey do so & more.\nShort strokes.\nTwisting wings.",
    ),
    "news": (
        HEAD + "<header><a href='/'>The Paper</a></header><nav><a href=/w>World</a> <a href=/s>Sport</a></nav>"
        "<main><article><h1>Rain expected</h1><p>It will rain, the office said on Monday.</p>"
        "<aside class='advertisement'>Buy umbrellas now, half price.</aside><p>More is to come on Tuesday.</p></article></main>"
        "<aside><h3>Most read</h3><ul><li><a href=/1>Sun</a></li></ul></aside>"
        "<form class=newsletter><label>Get our letter</label><input><button>Go</button></form><footer><p>Imprint</p></footer>",
        "Rain expected\nIt will rain, the office said on Monday.\nMore is to come on Tuesday.",
    ),
    "nothing": (HEAD + "<nav><ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul></nav><footer>© X</footer>", ""),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_pages_written_by_hand(model, name):
    page, want = PAGES[name]
    assert ht.Reader(model).article(page) == want


class _Article(HTMLParser):
    """Text of the article element, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.on, self.parts, self.blocks = False, "", []

    def end_block(self):
        text, self.parts = " ".join(self.parts.split()), ""
        if text and self.on:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article"):
            self.end_block()
        self.on |= tag == "article"
        self.parts += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.end_block()
        self.on &= tag != "article"

    def handle_data(self, data):
        self.parts += data


def test_query_beside_the_article_element(spark):
    got = {r["page_id"]: r for r in QUERIES["op12_html_extraction"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(rows) == len(got)
    for row in rows:
        parser = _Article()
        parser.feed(row["html"])
        parser.close()
        assert got[row["page_id"]]["text"] == "\n".join(parser.blocks)
        assert got[row["page_id"]]["n_chars"] == len(got[row["page_id"]]["text"]) and got[row["page_id"]]["url"] == row["url"]


def test_odd_rows(spark, model):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "u", "<article><p>a b.</p></article>", "t"), (3, "u", "<p>", "t")]
    rows += [(4, "u", "<article><p>x y z.</p></article>", "t")] * 2
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, text STRING")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in ht.main_texts(pages, model).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "u", "a b.", 4), (3, "u", "", 0)] + [(4, "u", "x y z.", 6)] * 2, key=str)
    assert ht.main_texts(pages.limit(0), ht.train(pages.limit(0), layout_pages=0)).collect() == []
    assert ht.train(pages.limit(0), layout_pages=5).weight
    assert all(MARK not in b.text for b in ht.labels_of_layout(labelled_pages(1, 1)[0])[0])
