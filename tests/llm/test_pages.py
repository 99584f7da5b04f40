import html as entities
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanwatch.llm import pages
from lanwatch.llm.queries import QUERIES
from tests.conftest import SF001

PAGES = "page_id long, url string, html string"


def brute(page):
    """The only article of a page of the table, by patterns."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1|h2|ul|li|div|blockquote)(?:\s[^>]*)?>", re.sub(r"<br>", " ", body))
    texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_query_equals_brute_force(spark):
    want = {r.page_id: (r.url, brute(r.html)) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op13_page_text"](spark, SF001).collect()}
    assert {k: (r.url, r.text) for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


LONG = "Words of the article that go on for a while, as articles do, and then some more of them. " * 3
OUTSIDE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Menu</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. """ + LONG + """</p></div><div id="adBanner">Buy now</div>%s
<aside><p>""" + LONG + """</p></aside><section id="comments"><article class="comment"><p>""" + LONG + """</p></article></section>
<form><p>Your name <input></p></form><footer>&copy; 2024</footer></body></html>"""
ARTICLE = f"<h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p><ul><li>one<li>two <b>bold</b></ul><p>{LONG}<br>after"
WANT = "\n\n".join(["Title & more", LONG.strip(), "Short.", "one", "two bold", LONG.strip() + " after"])


@pytest.mark.parametrize("around", [
    "<article>%s</article>", "<main>%s</main>", "<main><div><article class='post with-comments'>%s</article></div></main>",
    "<div id=page><div class=content>%s</div></div>", "<article>%s", "<article>%s<div class=share><a href=x>Share</a></div></article>",
    "<article>%s<section class='comments'><article><p>" + LONG + "</p></article></section></article>",
    "<article><script>if (a < b) { x('</p>') }</script><!-- <p>no</p> -->%s<form>no</form><aside>" + LONG + "</aside></article>"])
def test_article_without_what_surrounds_it(around):
    assert pages.extract(OUTSIDE % (around % ARTICLE)) == WANT


def test_headers_names_and_hidden():
    assert pages.extract(f"<article><header><h1>Head</h1><p>By me</p></header><p>{LONG}</p></article>") == f"Head\n\n{LONG.strip()}"
    assert pages.extract(f"<article><div class='entry-header'><h2>Head</h2>3 min</div><p>{LONG}</p></article>") == f"Head\n\n{LONG.strip()}"
    assert pages.extract(f"<article><p>{LONG}</p><p hidden>x</p><div style='display: none'>y</div><p role=alert>z</p></article>") == LONG.strip()


def test_link_lists_go_without_an_article():
    links = "".join(f"<li><a href='/{i}'>Page number {i}</a></li>" for i in range(12))
    page = f"<body><div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p><ul>{links}</ul></div></body>"
    assert pages.extract(page) == f"{LONG.strip()}\n\n{LONG.strip()}"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n", ""), ("<p></p><br>", ""), ("just text", "just text"), ("a &lt;b&gt; &eacute;&#233;&#x1F600; &nosuch; &amp;amp;", "a <b> éé😀 &nosuch; &amp;"),
    ("<p>a\t\n b&nbsp;c</p>", "a b c"), ("</p></div><p>x</b></i>y", "xy"), ("<article><p>a<p>b<div>c</article>", "a\n\nb\n\nc"),
    ("<script>never closed <p>x</p>", ""), ("<article><p>x", "x"), ("<p>a<b", "a"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ("<ARTICLE><P CLASS=x>Up<BR/>per</P></ARTICLE>", "Up per"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n\nd\n\nu")])
def test_edges(page, text):
    assert pages.extract(page) == text


def test_streaming_does_not_change_the_result(monkeypatch):
    page = OUTSIDE % f"<article>{ARTICLE}</article>"
    for size in (1, 7, 100):
        monkeypatch.setattr(pages, "FEED", size)
        assert pages.extract(page) == WANT


def test_very_long_page():
    assert len(pages.extract("<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>")) == 20_000 * (len(LONG.strip()) + 2) - 2
    assert pages.extract("x" * 3_000_000) == "x" * 3_000_000


def test_smoothing_and_threshold():
    flat = pages.smoothed(np.full(9, 5.0))
    assert np.allclose(flat, 5.0)
    peak = pages.smoothed(np.array([0.0, 0, 10, 0, 0]))
    weights = np.exp(-0.5 * np.arange(-2, 3) ** 2.0)
    assert np.isclose(peak[2], 10 / weights.sum()) and peak[1] == peak[3] > peak[0]
    x = np.array([1.0, 2, 1, 50, 60, 55])
    cut = pages.threshold(x)
    assert 2 < cut < 50 and pages.threshold(np.full(3, 4.0)) == 4.0


def test_rows(spark):
    rows = [(1, "u", None), (2, None, "<p>a</p>"), (2, None, "<p>a</p>"), (None, "v", "")]
    df = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))
    got = sorted((tuple(r) for r in pages.main_text(df).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (2, None, "a", 1), (2, None, "a", 1), (None, "v", "", 0)], key=repr)
    bad = df.limit(1).select(F.lit(5).alias("page_id"), "url", F.expr("cast(X'3C703E61FF3C2F703E' as string)").alias("html"))
    assert pages.main_text(bad).first().text == "a�"
    assert pages.main_text(df.limit(0)).collect() == []
