"""Main text (operator 1) and source mix (operator 8) against independent versions."""

import re
import time
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest

from cargolens.llm import html_main, mixing, queries
from tests.conftest import SF_SMALL

TEXT = "<p>First words of a story, long enough to count.</p><p>A second paragraph that goes on.</p>"
WANT = "First words of a story, long enough to count.\nA second paragraph that goes on."


class Plain(HTMLParser):
    """Blocks inside <article>, by the standard library's parser."""
    BREAKS = {"p", "h1", "h2", "h3", "li", "ul", "ol", "div", "article", "section", "table", "tr", "td", "blockquote"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.skip, self.out, self.now = 0, 0, [], []

    def cut(self):
        text = " ".join("".join(self.now).split())
        self.out += [text] if text else []
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in self.BREAKS:
            self.cut()
        self.depth += tag == "article"
        self.skip += tag in ("script", "style")
        if tag == "br":
            self.now.append(" ")

    def handle_endtag(self, tag):
        if tag in self.BREAKS:
            self.cut()
        self.depth -= tag == "article"
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        if self.depth and not self.skip:
            self.now.append(data)


def test_all_pages_against_the_standard_parser(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    want = {}
    for r in pages:
        p = Plain()
        p.feed(r.html or "")
        p.cut()
        want[r.page_id] = "\n".join(p.out)
    got = {r.page_id: r.text for r in queries.op1_consensus_main_text(spark, SF_SMALL).collect()}
    assert got == want


@pytest.mark.parametrize("shape", [
    '<div class="page-wrapper with-sidebar">{}</div>', '<article><div class="entry-content share-enabled">{}</div></article>',
    '<div class="content has-share">{}</div>', '<div id="skip-content">{}</div>', '<div class="side-by-side">{}</div>',
    '<div class="share">{}</div>', '<div class="comments">{}</div>', '<div class="mainSidebarLayout">{}</div>'])
def test_no_article_is_lost(shape):
    assert html_main.extract(f"<body>{shape.format(TEXT)}</body>")[0] == WANT


def test_noise_still_goes():
    page = ('<body><div class="post"><header class="entry-header"><h1>Title</h1></header><div class="entry-content">' + TEXT
            + '</div></div><div class="sidebar"><p>Aside words</p></div><div class="post-comments"><p>I think so too and say it at length</p></div>'
            '<div class="siteFooter"><p>All rights</p></div></body>')
    assert html_main.extract(page)[0] == "Title\n" + WANT


def test_hosts_vote(spark):
    body = "<p>Some words of text here.</p>" * 6
    one = lambda extra: f'<div class="a"><div class="b">{body}</div>{extra}</div>'
    two = '<div class="x"><div class="y">{}</div><div class="z"><p>tail words</p></div></div>'.format(body)
    rows = [(i, "http://h/1", one("")) for i in range(4)] + [(10 + i, "http://h/2", two) for i in range(3)]
    rows += [(20, "http://h/3", one(body * 2)), (21, "http://other/1", one("")), (22, "http://h/9", f'<div class="odd">{body}</div>')]
    got = {r.page_id: r for r in html_main.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    block = "Some words of text here."
    assert got[0].path == html_main.vote(one(""))[0] and got[0].text == "\n".join([block] * 6)
    assert got[10].path == html_main.vote(two)[0] != got[0].path                    # two templates on one host
    assert got[20].text == "\n".join([block] * 18)                       # the voted inner box holds a third: not taken
    assert got[22].text == "\n".join([block] * 6) and got[21].path == html_main.vote(one(""))[0]


@pytest.mark.parametrize("unit", ["<a", "<div>", "<p", "<!--", '<a "', "<script></script", "</div>", "<li>", "<td><tr>", "<a b='", "&#x", "<div class=a><p>x"])
def test_odd_markup_of_a_megabyte(unit):
    page = unit * (1_000_000 // len(unit))
    t = time.process_time()
    html_main.extract(page)
    assert time.process_time() - t < 12


def test_inclusion_follows_the_odds(spark):
    """200 sources of the same 40 documents: how often each is drawn against k * size / (1 + k * size)."""
    sizes = [5 + 7 * i for i in range(40)]
    rows = [(s * 1000 + i, " ".join(["w"] * n), f"s{s:03d}") for s in range(200) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    hits, taken = Counter(), defaultdict(int)
    for r in mixing.pareto_mix(df, weights=(1.0,), share=0.5).collect():
        assert r.copies in (0, 1)
        hits[r.doc_id % 1000] += r.copies
        taken[r.source] += r.taken
    x, total = np.array(sizes), sum(sizes)
    lo, hi = 0.0, 1.0
    for _ in range(100):
        k = (lo + hi) / 2
        lo, hi = (k, hi) if (k * x / (1 + k * x) * x).sum() < total / 2 else (lo, k)
    odds = k * x / (1 + k * x)
    seen = np.array([hits[i] for i in range(40)]) / 200
    assert np.abs(seen - odds).max() < 0.15 and np.abs(seen - odds).mean() < 0.04 and odds.max() - odds.min() > 0.4
    assert all(abs(t - total / 2) <= max(sizes) / 2 for t in taken.values())


def test_paths_have_stable_keys():
    path, key, held, fair = html_main.vote(f'<body class="p1"><div class="a b2">{TEXT}</div></body>')
    assert html_main.path_key(path) == key and key in fair and held > 0 and re.fullmatch(r"html>body\.p0>div\.a\.b0", path)
