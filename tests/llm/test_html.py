"""HTML extraction: blocks, gradients, given pages and layouts not trained on."""

import html
import re

import numpy as np
import pytest

from tripmart.llm import block_labeller as bl
from tripmart.llm import html_text
from tripmart.llm.html_blocks import blocks

MEDIUM = "/root/testdata/sf0.01/pages.parquet"


@pytest.fixture(scope="module")
def model(spark):
    return html_text.fit(spark.read.parquet(MEDIUM))


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert texts("<div>a<p>b<b>c<p>d</b></div>e<!-- x") == ["a", "bc", "d", "e"]
    assert texts("<p>x&nbsp;&nbsp;y\n\t&eacute;&amp;&lt;b&gt; &am &bogus; &#x41;<br>z</p>") == [
        "x y é&<b> &am &bogus; A z"]
    assert texts("a < b <script>if(a<b)'</p>'</script>c<style>p{}</style><title>t</title>") == ["a < b c"]
    assert texts("<ul><li>1<li>2<ul><li>3</ul></ul><table><tr><td>4<td>5</table>") == list("12345")
    assert texts('<p title="a>b" class=\'x\'>y</p><p class="broken>z</p>') == ["y", "z"]
    assert texts("<select><option>no<option>no</select>yes<svg><text>no</text></svg>") == ["yes"]
    assert texts("<script>never closed <p>x</p>") == texts("") == texts("<p> &nbsp; </p>") == []
    assert [b.path for b in blocks('<div class="mainMenu top" id=a1><h2>x</h3>y</div>')] == [
        ["div", ".main", ".menu", ".top", "#a1", "h2"], ["div", ".main", ".menu", ".top", "#a1"]]
    assert blocks("<li><a href=x>ab</a> cd</li>")[0].link_chars == 2
    long = "<p>" + "word " * 200_000 + "</p>" + "<b>" * 5000 + '<p class="' * 300
    assert len(texts(long)[0]) == 999_999


def test_gradients(monkeypatch):
    for name, size in (("PATHS", 16), ("WORDS", 16)):
        monkeypatch.setattr(bl, name, size)
    found = [blocks(f"<div class=a>{'x y ' * k}<p>b c<p>d") for k in (1, 2)] + [blocks("<p>q")]
    pages, labels = [], [np.array([1, 0, 1.0]), np.array([0, 1, 1.0]), np.array([1.0])]
    for f in found:
        page = bl.Features(f)
        page.paths, page.words = page.paths % 16, page.words % 16
        pages.append(page)
    model = bl.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        x, back, mask = model._inputs(pages)
        s = model._scores(x, back, False)[0]
        y = np.zeros(s.shape)
        for k, row in enumerate(labels):
            y[:len(row), k] = row
        return float((np.logaddexp(0, s) - y * s)[mask].sum() / mask.sum())

    g = model._gradients(pages, labels)
    rng = np.random.default_rng(1)
    for name, p in model.p.items():
        at = tuple(rng.integers(0, n) for n in p.shape) if name not in ("paths", "words") else (
            int((pages[0].paths if name == "paths" else pages[0].words)[0]), 1)
        old = p[at]
        p[at] = old + 1e-2
        up = loss()
        p[at] = old - 1e-2
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-2 - g[name][at]) < 2e-3, name


def test_given_pages_exactly(spark, model):
    pages = spark.read.parquet(MEDIUM)
    got = {r.page_id: r for r in html_text.extract(pages, model).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        art = r.html[r.html.index("<article>"):r.html.index("</article>")]
        want = " ".join(html.unescape(re.sub("<[^>]+>", " ", art)).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)
        assert got[r.page_id].url == r.url


def test_layouts_it_was_not_trained_on(spark, model):
    prose = [b.text for r in spark.read.parquet(MEDIUM).collect() for b in blocks(r.html)
             if b.text.count(" ") > 4]
    pages = [bl.marked(h) for h in bl.generated(300, prose, seed=12345)]
    scores = model.labels([bl.Features(b) for b, _ in pages])
    right = np.concatenate([(s > 0) == y for (_, y), s in zip(pages, scores)])
    assert right.mean() > 0.97


NEWS = """<!doctype html><html><head><title>T</title><script>var a="<p>no</p>";</script></head>
<body class="home"><div id="cookie-banner" class="notice">This site uses cookies. <button>OK</button></div>
<header class="site-header"><a href="/">The Daily</a><p>All the news</p>
<nav class="main-nav"><ul><li><a href="/w">World</a><li><a href="/s">Sport</a></ul></nav></header>
<div class="layout"><main><article class="story"><h1>Rain &amp; wind in the north</h1>
<p>Heavy rain fell in the <em>north</em> on Monday, and many roads were closed for hours.</p>
<div class="ad-slot">Advertisement<p>Buy the best umbrella today!</p></div>
<p>Officials said that the river&nbsp;rose by two metres before it fell again.</p>
<blockquote>We have never seen this much water in the town, said the mayor.</blockquote></article></main>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href=1>Storm damages harbour wall</a></ul></aside></div>
<section id="comments" class="comments"><h3>2 comments</h3><div class="comment"><b>ann</b>
<p>I was there and it was really very wet indeed.</p><a href="#">Reply</a></div></section>
<footer><p>&copy; 2024 The Daily. All rights reserved.</p></footer></body></html>"""


def test_a_page_by_hand(model):
    (page,) = html_text.content([NEWS], model)
    assert [b.text for b, score in page if score > 0] == [
        "Rain & wind in the north",
        "Heavy rain fell in the north on Monday, and many roads were closed for hours.",
        "Officials said that the river rose by two metres before it fell again.",
        "We have never seen this much water in the town, said the mayor."]


def test_awkward_rows(spark, model):
    schema = "page_id long, url string, html string, text string, at string, model string"
    body = "<article><h1>Title of it</h1>" + "<p>Some words of a long article, as ever.</p>" * 4000
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<br>"), (4, "w", body), (4, "w", body),
            (5, "x", "<nav><a href=/>Home</a></nav>")]
    pages = spark.createDataFrame([r + ("x",) * 3 for r in rows], schema).repartition(2)
    got = html_text.extract(pages, model).collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == 6 and [by_id[k].text for k in (1, 2, None, 5)] == [""] * 4
    assert by_id[4].n_kept == 4001 and by_id[4].url == "w"
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
