"""Main text by tag-path ratios: layouts, broken markup, the ratios against a slow version."""

import html
import re
from collections import defaultdict

import numpy as np
import pytest

from encore.llm.main_text import KERNEL, LEAST, extract_main_text, page_texts, path_ratios
from encore.llm.queries import QUERIES

from conftest import MEDIUM

A = "The first paragraph of the article is long enough to be told from a menu, with commas, and a full stop."
B = "A second one follows it; it has a <b>bold</b> word, a <a href='/x'>link</a> inside, and ends here."
B_TEXT = "A second one follows it; it has a bold word, a link inside, and ends here."
C = "The third paragraph closes the text. It has two sentences, which is usual for a paragraph."
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>About us</a></li></ul>"
WHOLE = f"Title {A} {B_TEXT} Short. {C}"
ARTICLE = f"<h1>Title</h1><p>{A}</p><p>{B}</p><p>Short.</p><p>{C}</p>"

LAYOUTS = {
    "article": f"<nav>{MENU}</nav><article>{ARTICLE}</article><footer>&copy; All of it, and more.</footer>",
    "main": f"<header><h1>Site</h1>{MENU}</header><main>{ARTICLE}</main><aside><p>{C}</p></aside>",
    "role": f"<div role='navigation'>{MENU}</div><div role='main'>{ARTICLE}</div><div role=contentinfo>Notes, and more.</div>",
    "classes": f"<div class='site-header'>{MENU}</div><div id=content class='post has-sidebar'>{ARTICLE}</div>"
               f"<div class='sideBar'><p>{C}</p></div><div id='comments'><div class=comment><p>{A}</p></div></div>"
               f"<div class='cookie-notice'>We use cookies, as all do.</div><div class=ad>Buy this, now.</div>",
    "bare divisions": f"<div>{MENU}</div><div>{ARTICLE}</div><div>{MENU}</div><div>Imprint</div>",
    "nested": f"<div><div>{MENU}</div><div><div><h1>Title</h1><p>{A}</p><p>{B}</p></div><div><p>Short.</p><p>{C}</p></div></div></div><div>{MENU}</div>",
    "flat": f"{MENU}{ARTICLE}{MENU}",
    "article with parts": f"<article><header><h1>Title</h1></header><p>{A}</p><p>{B}</p><form><p>Your name, please.</p></form><p>Short.</p>"
                          f"<div class='share'>Share this</div><p>{C}</p><footer>By me.</footer><section class='comments'><p>{A}</p></section></article>",
    "table": f"<table><tr><td>{MENU}<td>{ARTICLE}<td>{MENU}</table>",
    "comments as articles": f"<article>{ARTICLE}</article><div class=comments><article><p>{A}</p></article><article><p>{A} {A} {A} {A} {A} {A}</p></article></div>",
    "hidden": f"<div hidden><p>{C}</p></div><article>{ARTICLE}<p style='display: none'>{C}</p></article>",
    "scripts": f"<script>var a = '<p>{C}</p>';</script><style>p::after {{content: '</p>'}}</style><noscript>Switch it on, please.</noscript><article>{ARTICLE}</article>",
    "no end": f"<nav>{MENU}</nav><article><h1>Title</h1><p>{A}<p>{B}<p>Short.<p>{C}",
    "upper case": f"<NAV>{MENU}</NAV><ARTICLE><H1>Title</H1><P>{A}</P><P>{B}</P><P>Short.</P><P>{C}</P></ARTICLE>",
    "stray ends": f"</div></p><nav>{MENU}</nav></ul><article></section>{ARTICLE}</article></div>",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(layout):
    page = f"<!DOCTYPE html><html><head><title>Title of the page, with a comma</title></head><body>{LAYOUTS[layout]}</body></html>"
    assert page_texts([page]) == [WHOLE]


def test_white_space_references_and_comments():
    page = ("<article><p>a &lt;b&gt; &amp;amp; c&nbsp;d &#233;&#x4E2D;  e\n\tf<!-- <p>no</p> -->g<br>h<wbr>i 1 < 2 &unknown; &copy</p>"
            "<p> </p><p>k<b>l</b> <i>m</i></p><ul><li>one<li>two</ul></article>")
    assert page_texts([page]) == ["a <b> &amp; c d é中 e fg hi 1 < 2 &unknown; © kl m one two"]


def test_broken_and_empty_pages():
    assert page_texts([None, "", "   ", "<html></html>", "<nav><a href=x>only a menu</a></nav>"]) == [""] * 5
    assert page_texts(["plain text, no markup"]) == ["plain text, no markup"]
    assert page_texts(["<article><p>one, two.</p><!-- no end <p>three</p>"]) == ["one, two."]
    assert page_texts(["<article><p>one, two.</p><script>no end <p>three</p>"]) == ["one, two."]
    assert page_texts(["<article><p title=\"no end>one, two.</p><p>three.</p>"]) == ["one, two. three."]
    assert page_texts(["<article><p>one, two.</p><p>three <di"]) == ["one, two. three"]
    long = "<article>" + "<div>" * 3000 + "deep, deep." + "</div>" * 3000 + "<p>word, </p>" * 20_000
    assert page_texts([long]) == ["deep, deep. " + " ".join(["word,"] * 20_000)]


def test_ratios_match_slow_version():
    rng = np.random.default_rng(5)
    count = rng.integers(0, 9, 40)
    page = np.repeat(np.arange(40), count)
    path = page * 3 + rng.integers(0, 3, len(page))
    chars, marks = rng.integers(1, 200, len(page)), rng.integers(0, 6, len(page))
    linked = np.minimum(chars, rng.integers(0, 100, len(page)) * rng.integers(0, 2, len(page)))
    content, in_links = path_ratios(page, path, chars, linked, marks, 120)
    for k in range(40):
        rows = np.flatnonzero(page == k)
        by = defaultdict(list)
        for r in rows:
            by[path[r]].append(r)
        length = {p: sum(chars[r] for r in v) / len(v) for p, v in by.items()}
        mark = {p: sum(marks[r] for r in v) / len(v) for p, v in by.items()}
        links = {p: sum(linked[r] for r in v) / sum(chars[r] for r in v) for p, v in by.items()}
        fused = []
        for at, r in enumerate(rows):
            near = [(KERNEL[d + 2], path[rows[at + d]]) for d in range(-2, 3) if 0 <= at + d < len(rows)]
            mean = lambda of: sum(w * of[p] for w, p in near) / sum(w for w, _ in near)  # noqa: B023, E731
            fused.append(mean(length) * (0.5 + mean(mark)) * (1 - links[path[r]]))
        level = sum(f * chars[r] for f, r in zip(fused, rows)) / max(1, sum(chars[r] for r in rows))
        for p, v in by.items():
            ratio = sum(f for f, r in zip(fused, rows) if path[r] == p) / len(v)
            assert content[p] == (ratio > 0 and ratio >= LEAST * level)
            assert in_links[p] == pytest.approx(links[p])


def _article(source):
    """The main text of the test pages' one layout."""
    inner = re.search("<article>(.*)</article>", source, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub("</?b>", "", re.sub("</?(p|h1|br)>", " ", inner))).split())


def test_query_on_whole_table(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet").collect()
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in QUERIES["op11_main_text"](spark, MEDIUM).collect()}
    assert got == {r.page_id: (r.url, _article(r.html), len(_article(r.html))) for r in pages}


def test_edges(spark):
    rows = [(1, "u", LAYOUTS["article"], "clash"), (1, "u", LAYOUTS["article"], "clash"), (None, None, None, None), (2, "v", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    got = sorted(extract_main_text(df).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", WHOLE, len(WHOLE))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract_main_text(df.limit(0)).columns == ["page_id", "url", "text", "n_chars"]
    assert extract_main_text(df.limit(0)).count() == 0
