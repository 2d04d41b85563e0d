import html
import os
import re
import time

import pyarrow.parquet as pq
import pytest

from lexmill.llm import htmltext as h

PAGES = "/root/testdata/sf0.001/pages.parquet"
LONG = "This sentence is part of the main text of the page and it is long enough to count as content. " * 3


def article_text(page):
    """What stands between the article tags, cut at block tags by plain search."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = re.split(r"</?(?:p|h1|div)\b[^>]*>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


@pytest.mark.skipif(not os.path.exists(PAGES), reason="no tables here")
def test_whole_table():
    pages = pq.read_table(PAGES).to_pylist()
    assert [h.main_text(p["html"]) for p in pages] == [article_text(p["html"]) for p in pages]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("just text  &amp; more", "just text & more"), ("<p>one<p>two", "one\ntwo"),
        (f"<html><head><title>T</title><style>x{{}}</style></head><body><header>Site</header><nav><a>Home</a></nav><main><h1>Head</h1><p>{LONG}</p><p>Short.</p><aside>see also</aside><form><input>go</form></main><div class='cookie-notice'>We use cookies</div><footer>(c)</footer></body></html>", f"Head\n{LONG.strip()}\nShort."),
        (f"<body><div id=menu><ul><li><a href=/>A</a><li><a href=/b>B</a></ul></div><div class=story><h2>Title</h2><p>{LONG}<br>next</p><ul><li>point one<li>point two</ul><p>{LONG}</p></div><section class='comments'><p>{LONG}</p></section></body>", f"Title\n{LONG.strip()} next\npoint one\npoint two\n{LONG.strip()}"),
        (f"<article><p>{LONG}</p><div class='ad'>Buy {LONG}</div><script>var p='<p>no</p>';</script><p>a &lt;b&gt; &#8364;</p><article class=comment>bad</article></article>", f"{LONG.strip()}\na <b> €"),
        ("<article><p><b>open<br><p>never closed &am", "open\nnever closed &am"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes <i>in</i>line<span>s</span></p></article>", "yes inlines"),
        ("<nav>only a menu</nav>", ""),
        ("<p>" * 3000 + "deep", "deep"),
    ],
)
def test_pages(page, want):
    assert h.main_text(page) == want


def test_extract(spark):
    rows = spark.createDataFrame([(1, "u", "<p>a é</p>", "t"), (2, None, None, "t"), (1, "u", "<p>a é</p>", "t")], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, h.extract(rows).collect()))
    assert got == [(1, "u", "a é", 3), (1, "u", "a é", 3), (2, None, "", 0)] and h.extract(rows.limit(0)).count() == 0


def test_smoothing_and_threshold():
    assert h.smoothed([5.0] * 7) == pytest.approx([5.0] * 7)
    lines = [h.Line(text="x" * n, tags=1) for n in (3, 2, 200, 300, 250, 3, 2)]
    assert {2, 3, 4} <= set(h.seeds_of(lines)) and 0 not in h.seeds_of(lines)


def plain(pages=80):
    """A page without an article: menus of links, then text, then more links, none of them told by tag or class."""
    links = "".join(f"<li><a href=/{k}>Go to page {k}</a></li>" for k in range(12))
    return f"<body><ul>{links}</ul><h1>A heading</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p><p>The end.</p><ul>{links}</ul></body>"


def test_clusters_decide_where_markup_does_not():
    assert h.main_text(plain()) == f"A heading\n{LONG.strip()}\nShort one.\n{LONG.strip()}\nThe end."


@pytest.mark.parametrize("seeds", [lambda lines: [0], lambda lines: [len(lines) - 1], lambda lines: list(range(len(lines)))])
def test_other_seeds_give_other_text(monkeypatch, seeds):
    before = h.main_text(plain())
    monkeypatch.setattr(h, "seeds_of", seeds)
    assert h.main_text(plain()) != before


def test_of_several_articles_those_with_seeds_are_content():
    page = f"<body><article><a href=/1>Teaser</a></article><article><p>{LONG}</p><p>Tiny.</p></article><article><a href=/2>More</a></article></body>"
    assert h.main_text(page) == f"{LONG.strip()}\nTiny."


@pytest.mark.parametrize(("page", "want"), [("<p>a</p><![foo[bar]]><p>b</p>", "a\nb"), ("<p>a<![if x]>b<![endif]></p>", "ab"), ("<p>a</p><![", "a"), ("<p>a</p><!", "a"), ("a<![CDATA[x", "a")])
def test_marked_sections_are_comments(page, want):
    assert h.main_text(page) == want


@pytest.mark.parametrize("page", ["<div>a" * 170_000, "<b>a" * 170_000 + "</i>" * 1000, "<div>" * 100_000 + "</p>" * 100_000 + "x", "<table><tr><td>a" * 60_000, "<ul><li>a" * 90_000, "<p>word word word</p>" * 50_000])
def test_a_megabyte_of_nesting_takes_linear_time(page):
    began = time.process_time()
    assert h.main_text(page)
    assert time.process_time() - began < 6


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<body><main><h1>Head</h1><div class=text><p>{LONG}</p><p>Short.</p></div><aside>no</aside></main></body>", f"Head\n{LONG.strip()}\nShort."),
        (f"<body><ul><li><a href=/>Home</a></ul><h1>Head</h1><div class=text><p>{LONG}</p><p>Short.</p></div><footer>no</footer></body>", f"Head\n{LONG.strip()}\nShort."),
        (f"<main><p>Intro</p><article><p>{LONG}</p></article></main>", LONG.strip()),
    ],
)
def test_main_parts_and_headings(page, want):
    assert h.main_text(page) == want
