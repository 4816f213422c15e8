"""Main text of hand-made pages, template deduction, and a plain reading of the given pages."""

import html
import re

from tabscore.llm import page_text as pt


def text(source, template=frozenset()):
    return pt.main_text(source, template)[0]


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
    <article><h1>A &amp; B &lt;c&gt;</h1><p>One <b>two</b><br>three&nbsp;&#233;<p>Four
    five<ul><li>x<li>y</ul><form><input value="q"><button>Go</button></form><div class="share-bar">Share</div>
    <table><tr><td>c1<td>c2</table><blockquote>Quote</blockquote><section id="comments"><p>Nice!</p></section><article class="comment">Me too</article></article>
    <aside>Side</aside><footer>&copy; me</footer></body></html>"""
    assert text(page).split("\n\n") == ["A & B <c>", "One two three é", "Four five", "x", "y", "c1", "c2", "Quote"]


def test_pages_without_article_and_broken_markup():
    assert text("<body><div id=menu>m</div><main><p>a</main><p>b") == "a"
    assert text("<div class='sidebar'>s</div><p>a<p>b") == "a\n\nb"
    assert text("plain text & more") == "plain text & more"
    for bad in (None, "", "<", "<p", "<p class=\"x", "<!-- never closed", "<script>x", "</div></p>", "<a href='>'>", "<p>a < b</p>", "<![CDATA[x", "<<<>>>", "<p>\x00</p>"):
        pt.main_text(bad)
    assert text("<p>a < b</p>") == "a < b" and text("<p title='a>b'>c</p>") == "c"
    assert text("<p>" + "word " * 200_000 + "</p>") == ("word " * 200_000).strip()
    assert len(text("<div>" * 3000 + "deep" + "</div>" * 10)) == 4


def test_template_of_a_host(spark):
    rows = [(i, f"https://Host.example/{i}", f"<html><body><article><p>Story {i} {'w' * 40}</p>{'<p>more</p>' * (i % 3)}<p>Read our terms of use here</p></article></body></html>", "x") for i in range(8)]
    rows += [(100 + i, f"https://copies.example/{i}", "<html><body><article><p>Same story</p></article></body></html>", "x") for i in range(6)]
    rows += [(200, None, "<html><body><p>no host</p></body></html>", "x"), (None, "https://host.example/z", None, "x"), (201, "https://one.example/", "", None), (201, "https://one.example/", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {}
    for r in pt.extract(df).collect():
        got.setdefault(r.page_id, r)
    assert pt.extract(df).count() == len(rows)
    assert got[4].text == f"Story 4 {'w' * 40}\n\nmore" and got[4].n_template == 1 and got[4].n_chars == len(got[4].text)
    assert got[101].text == "Same story" and got[200].text == "no host" and got[None].text == "" and got[201].n_chars == 0
    t = pt.templates(df).where("host = 'host.example'").collect()
    assert {r.class_id for r in t} and sum(not r.is_tag for r in t) == 1
    assert pt.extract(df.limit(0)).count() == 0


def test_given_pages(spark):
    def plain(source):
        inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        return "\n\n".join(x for x in parts if x)
    rows = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = pt.op2_page_text(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    assert [r.page_id for r in got if r.text != plain(rows[r.page_id].html)] == []
