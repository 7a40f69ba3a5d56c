import math
import random
import time

import pytest
from llm_cases import bag

from pledgeline.llm import html_extract

LONG = "These are words of a paragraph that is long enough to stand out on the page. " * 4
MENU = "<ul>" + "".join(f'<li><a href="/{k}">Menu {k}</a></li>' for k in range(8)) + "</ul>"

CASES = {
    None: "",
    "": "",
    "<html><body></body></html>": "",
    "just   text &amp; no\n tags": "just text & no tags",
    "<p>one<p>two <b>bold</b>text<br>next&nbsp;x": "one\n\ntwo boldtext next x",
    # an article with short paragraphs, unclosed inline elements and a title in its header
    f"<nav>{MENU}</nav><div class='ad'>{LONG}</div><article><header><h1>Title</h1></header>"
    f"<p><b>{LONG}<br><p>Tiny.</p><p>&lt;tag&gt; &#233;</p><aside>{LONG}</aside>"
    f"<form><input value=x>Your name</form></article><section id=comments><p>{LONG}</p></section>"
    f"<footer>&copy; {LONG}</footer>": f"Title\n\n{LONG.strip()}\n\nTiny.\n\n<tag> é",
    # no article element: the region is the element with most of the text
    f"<div id=top>{MENU}</div><div id=x><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
    f"<div class='side-bar sidebar'><p>{LONG}</p></div>": f"Head\n\n{LONG.strip()}\n\nShort.\n\n{LONG.strip()}",
    # scripts, styles, comments, hidden and unclosed parts
    f"<script>var a='<p>{LONG}</p>'</script><style>p{{}}</style><!-- <p>{LONG}</p> --><main>"
    f"<p hidden>{LONG}</p><div style='display: none'>{LONG}</div><p>{LONG}</p><ul><li>a<li>b</ul>"
    f"<noscript>{LONG}</noscript></main>": f"{LONG.strip()}\n\na\n\nb",
    # everything bears a hint
    "<div class=sidebar><p>only this</p></div>": "only this",
    "<article class=comment><p>first!</p></article><article><p>body</p></article>": "body",
    "<p>a < b and c > d & e": "a < b and c > d & e",
    "<table><tr><td>c1<td>c2<tr><td>c3</table>": "c1\n\nc2\n\nc3",
}


@pytest.mark.parametrize("html", CASES, ids=range(len(CASES)))
def test_main_text(html):
    assert html_extract.main_text(html) == CASES[html]


PAGE = "<div id=top>{0}</div><div id=post>{1}</div><div class=sidebar><p>{2}</p></div>"
ITEMS = [f"Item {k} of a list, with as many words as the items of a list may have. " * 2 for k in range(10)]
FOUR, TEN = ("x" * 39 + " ") * 10, ("y" * 39 + " ") * 25

#: Nested articles without ``article`` or ``main``, with their lines.
NESTED = {
    f"<h1>T</h1><p>{FOUR}</p><section><p>{TEN}</p></section>": ["T", FOUR, TEN],
    f"<section><p>{TEN}</p></section><section><h2>S</h2><p>{FOUR}</p></section>": [TEN, "S", FOUR],
    f"<p>{LONG}</p><ul>{''.join(f'<li>{i}' for i in ITEMS)}</ul><p>{LONG}</p>": [LONG, *ITEMS, LONG],
    f"<div><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p></div>": [LONG] * 3,
    f"<p>{FOUR}</p><blockquote><p>{TEN}</p></blockquote><p>Tiny.</p><p>{FOUR}</p>": [FOUR, TEN, "Tiny.", FOUR],
    f"<div><p>{TEN}</p></div><table><tr><td>{FOUR}</table>": [TEN, FOUR],
}


@pytest.mark.parametrize("html", NESTED, ids=range(len(NESTED)))
def test_nested_regions_lose_no_line(html):
    got = html_extract.main_text(PAGE.format(MENU, html, LONG))
    assert got.split("\n\n") == [line.strip() for line in NESTED[html]]


PARA = "A paragraph of the article with quite some words in it, so that it stands out here. " * 3
LINKS = "".join(f"<li><a href='/{k}'>Link number {k}</a></li>" for k in range(20))
ARTICLES = {
    # text of the article beside the element
    f"<article><p>{LONG}</p></article><div><p>{LONG[:150]}</p></div>": [LONG, LONG[:150]],
    f"<main><p>{LONG}</p><p>{LONG}</p></main><div><h2>More</h2><p>{LONG}</p><p>x</p><p>{PARA}</p></div>":
        [LONG, LONG, "More", LONG, "x", PARA],
    # names that only contain a hint
    **{
        f"<article><p>{PARA}</p><div class='{name}'><p>{PARA}</p></div></article>": [PARA, PARA]
        for name in ("legal-analysis", "social-impact", "related-work", "lead-in share", "search-history")
    },
    # and names that are one
    **{
        f"<article><p>{PARA}</p><div class='{name}'>{more}</div><p>{PARA}</p></article>": [PARA, PARA]
        for name, more in {
            "share-buttons": "<a href=x>Mail</a> <a href=y>Print</a>",
            "related": f"<ul>{LINKS}</ul>",
            "ad-slot-2": f"<p>{PARA}</p>",
            "cookie-notice": f"<p>{PARA}</p>",
            "commentList": f"<p>{PARA}</p>",
        }.items()
    },
    # menus without a hint
    f"<main><div><a href=a>Home</a> <a href=b>About</a></div><p>{PARA}</p><ul>{LINKS}</ul></main>": [PARA],
    f"<article><p>{PARA}</p><ul>{LINKS}</ul><p>{PARA}</p></article>": [PARA, PARA],
    # one link between paragraphs is text
    f"<article><p>{PARA}</p><p><a href=x>The whole report</a></p><p>{PARA}</p></article>":
        [PARA, "The whole report", PARA],
}


@pytest.mark.parametrize("html", ARTICLES, ids=range(len(ARTICLES)))
def test_clusters_decide_in_articles(html):
    page = f"<nav>{MENU}</nav>{html}<footer>{LONG}</footer>"
    assert html_extract.main_text(page).split("\n\n") == [line.strip() for line in ARTICLES[html]]


def test_ratio_smoothing_and_threshold_by_hand():
    """Against sums over all lines, each written out."""
    draw = random.Random(3)
    for _ in range(30):
        lines = []
        for _ in range(draw.randint(1, 40)):
            text = "x" * draw.choice([3, 10, 80, 400])
            links = draw.choice([0, 0, len(text), len(text) // 2])
            lines.append(
                html_extract.Line(text, draw.randint(0, 4), links, draw.random() < 0.2, None, False, None)
            )
        ratios = [0 if n.apart else (len(n.text) - n.link_chars) / max(n.tags, 1) for n in lines]
        if not any(ratios):
            ratios = [0 if n.apart else len(n.text) for n in lines]
        smooth = []
        for i in range(len(lines)):
            near = [(math.exp(-((i - j) ** 2) / 4.5), r) for j, r in enumerate(ratios) if abs(i - j) <= 4]
            smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
        mean = sum(smooth) / len(smooth)
        deviation = math.sqrt(sum((v - mean) ** 2 for v in smooth) / len(smooth))
        got = html_extract.content_lines(lines)
        for chosen, v, r in zip(got, smooth, ratios):
            if abs(v - deviation) > 1e-9:
                assert bool(chosen) == (r > 0 and (v > deviation or deviation == 0))


@pytest.mark.parametrize("page", [
    "<div>word" * 16_000,
    "<div>" * 16_000 + "</section>" * 16_000 + "word",
    "<p><i>" + "<b>" * 16_000 + "</i>x" * 4000,
    "<ul><li>word" * 12_000,
    "<article><div class=share>word" * 5000,
])
def test_deep_nesting_takes_linear_time(page):
    began = time.process_time()
    assert html_extract.main_text(page)
    assert time.process_time() - began < 2


def test_very_long_pages():
    text = html_extract.main_text("<article>" + "<p>word</p>" * 50_000 + "</article>")
    assert text.count("word") == 50_000
    assert html_extract.main_text("<div>" * 3000 + "deep") == "deep"
    assert html_extract.main_text("x" * 3_000_000) == "x" * 3_000_000


def test_smoothing_keeps_the_level():
    import numpy as np

    assert np.allclose(html_extract.smoothed(np.full(30, 5.0)), 5.0)
    assert html_extract.smoothed(np.zeros(0)).size == 0


def test_table(spark):
    pages = [(k, None if k % 2 else f"u{k}", html, 7) for k, html in enumerate(CASES)]
    pages += [pages[4], (None, None, None, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text long").repartition(2)
    got = html_extract.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert bag(got.collect()) == bag((i, u, CASES[h], len(CASES[h])) for i, u, h, _ in pages)
    assert html_extract.extract(df.filter("false")).count() == 0
