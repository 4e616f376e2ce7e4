from __future__ import annotations

import html
import re

import pytest

from lathework.llm import html as h


def template_text(page):
    """The article of the driver's pages, taken apart by their template."""
    body = re.sub(r"<[^>]*\Z", "", page.split("<article>", 1)[1].split("</article>")[0])
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p|br)>", body))
    return "\n".join(b for b in blocks if b)


def test_driver_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = h.extracted(pages, h.learn(pages)).collect()
    assert len(rows) == 250
    assert all(r.text == template_text(r.html) for r in rows)


PAGE = """<html><head><title>T</title><style>p{a:"<p>"}</style></head><body><header><h2>Site name</h2></header>
<nav><ul><li><a href="/a>b">Home page of the site</a></ul></nav>
<div class="cookie-notice">We use cookies on this site today</div>
<div id=main><h1>A title &amp; more</h1><p>First&nbsp;paragraph with <b>bold <i>words</b> in it
and  a line<br>break here<p>Second one &lt;b&gt; with enough words in it<div class='ad'>Buy this now please</div>
<ul><li>point one of the list<li>point two of the list</ul><table><tr><td>a cell with words<td>another cell</table>
<p>Third one closes the text for now.</p></div>
<aside>Related: many other words on other pages</aside><section class="comments"><p>Reader says many words here, words and words.</p></section>
<form><label>Search all words</label></form><script>if (a<b) document.write("<p>no</p>")</script>
<footer>All rights reserved by the site</footer></body></html>"""

TEXT = """A title & more
First paragraph with bold words in it and a line
break here
Second one <b> with enough words in it
point one of the list
point two of the list
a cell with words
another cell
Third one closes the text for now."""


def test_furniture_goes_and_blocks_stay():
    assert h.main_text(PAGE, h.Weights()) == TEXT


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain words", "plain words"), ("a < b and c > d", "a < b and c > d"),
    ("<p>cut off &am", "cut off &am"), ("<p>cut off<foot", "cut off"), ('<p>cut off<a href="x', "cut off"),
    ("<p>one<!-- two --> three", "one three"), ("<p>one<!-- never ends", "one"), ("<p>one<script>never ends", "one"), ("&#8364; 5", "€ 5"),
    ("<div id=header>Site</div><p>The text</p><div class='article-header'>Its end</div>", "The text\nIts end"), ("<P CLASS=x>Upper</P>", "Upper"), ("</p></div>stray", "stray"),
])
def test_odd_pages(page, text):
    assert h.main_text(page, h.Weights()) == text


def test_best_run_against_brute_force():
    import random
    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.choice([-2.0, -1.0, 0.5, 1.0, 3.0]) for _ in range(rng.randrange(0, 14))]
        begin, end = h.best_run(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores) + 1) for j in range(i, len(scores) + 1)), default=0)
        assert sum(scores[begin:end]) == best


def test_long_pages_take_linear_time():
    import time
    for page in ("<" * 300_000, "<p>a" * 100_000, "<a href=\"" * 60_000, "<!--" * 100_000, "<div>" * 3_000 + "x" + "</div>" * 3_000, "</div>" * 100_000, "<div>" * 3_000 + "</b></p>" * 50_000):
        begin = time.time()
        h.main_text(page, h.Weights())
        assert time.time() - begin < 20


def test_odd_tables(spark):
    rows = [(1, "u", PAGE, "x", 3), (1, "u", PAGE, "x", 3), (None, None, "<article><p>in words</p></article><p>out</p>", None, None), (2, None, None, "y", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    out = h.extracted(pages, h.learn(pages))
    assert out.columns == ["page_id", "url", "html", "n_chars", "text"]
    assert sorted(r.text for r in out.collect()) == sorted([TEXT, TEXT, "in words", ""])
    assert h.extracted(pages.limit(0), h.learn(pages.limit(0))).count() == 0


@pytest.mark.parametrize("begin, end", [
    ("<body class='has-sidebar'>", "</body>"), ("<body class='no-comments sidebar'>", "</body>"), ("<html class=nav><body>", "</body></html>"),
    ("<div id='page-with-nav'>", "</div>"), ("<article class='post comment-open'>", "</article>"), ("<main class=search>", "</main>"),
    ("<form id=page>", "</form>"), ("<form><main>", "</main></form>"), ("<div class=sidebar><article>", "</article></div>"), ("<div class=modal><main>", "</main></div>"),
])
def test_furniture_never_takes_the_page(begin, end):
    page = f"{begin}<nav>Home and away</nav><h1>Title here</h1><p>The text of the page</p><div class='site-nav'>Links</div>{end}"
    assert h.main_text(page, h.Weights()) == "Title here\nThe text of the page"


def test_furniture_that_holds_articles_beside_the_article_stays_furniture():
    page = "<article><p>The text of the page</p></article><aside><article>Another page and its many words</article></aside><form>Your mail</form>"
    assert h.main_text(page, h.Weights()) == "The text of the page"
    assert h.main_text("<p>The text of the page</p><div id=comments><article class=comment>Many words of a reader</article></div>", h.Weights()) == "The text of the page"
