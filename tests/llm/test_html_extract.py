import html
import re
import time

import pytest

from orderlake.llm import html_extract, queries
from orderlake.llm.html_extract import content


def test_every_page_against_its_article_element(spark):
    """The generated pages hold their text in one article element; a plain
    reading of that element is the expected result."""
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op5_html_extraction(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        body = pages[r["page_id"]]["html"].split("<article>", 1)[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*$", "", body))
        lines = [" ".join(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split())
                 for p in parts]
        assert r["text"] == "\n".join(x for x in lines if x)
        assert r["n_chars"] == len(r["text"])


LONG = "Words and words, one after another, make a sentence. "


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain  text,\n here.", "plain text, here."),
    ("<p>a, b.<p>c, d.", "a, b.\nc, d."),
    ("<article><p>x &amp; y&#33; &lt;b&gt;</article>", "x & y! <b>"),
    ("<article><p>one <b>two</b><i>three</i></p></article>", "one twothree"),
    ("<article>" + "<p>z, z.</p>" * 2 + "<script>if (a < b) '</p>'</script><p>end, it is.",
     "z, z.\nz, z.\nend, it is."),
    ("<article><p>cut off, he", "cut off, he"),
    ("<article><p>cut, off <a href=\"x", "cut, off"),
    ("<article><p>1 < 2, and 3 > 2.</p></article>", "1 < 2, and 3 > 2."),
    ("<ARTICLE><P CLASS='lead'>Up, case.</P></ARTICLE>", "Up, case."),
])
def test_small_pages(page, text):
    assert content(page) == text


def test_everything_around_the_article_goes():
    page = f"""<html><head><title>T, t.</title></head><body class="page no-sidebar">
      <header><h1>Site, of things.</h1></header><nav><a href=/>Home, sweet.</a></nav>
      <div class="cookie-notice">{LONG}</div><div id="content"><h2>Heading here</h2>
      <p>{LONG}</p><ul><li>{LONG}<li>{LONG}</ul><form><p>{LONG}</p></form>
      <div class="comments"><p>{LONG * 3}</p></div><div class='ad box'>{LONG}</div></div>
      <aside>{LONG}</aside><div>Buy now</div><footer><p>{LONG}</p></footer></body></html>"""
    assert content(page) == "\n".join(["Heading here"] + [LONG.strip()] * 3)


def test_values_decide_over_names():
    page = f"""<nav><a href=/>Home</a></nav><div class='share-story'><h1>Title here</h1><p>{LONG * 3}
      <p>{LONG * 4}<div class='box-7'><p>Buy now!</p><ul><li><a href=x>One link, of many.</a>
      <li><a href=y>Two of them.</a></ul></div></div><div>Buy now</div>"""
    assert content(page) == "\n".join(["Title here", (LONG * 3).strip(), (LONG * 4).strip()])
    assert content("<div class='ad'>" + page) == content(page)      # all under one name: no change


@pytest.mark.parametrize("inner, kept", [
    ("<ul><li>Flour<li>Sugar</ul>", True),                          # parts of the text
    ("<blockquote><p>Short</blockquote>", True),
    ("<h3><a href=x>Linked heading</a></h3>", True),
    ("<p>Some <a href=x>linked words</a>, as in all texts.", True),
    ("<ul><li><a href=x>Linked text only</a></ul>", False),
    ("<p class=promo>Buy now, please.", False),
    ("<div class=comments><article><p>" + LONG * 3 + "</article></div>", False),
    ("<div class=box><div><p>Buy now!</div></div>", False),
    ("<div class=box><div><p>" + LONG * 2 + "</div></div>", True),
])
def test_what_stands_in_an_article(inner, kept):
    page = "<div class=text><p>" + LONG * 2 + "<p>" + LONG * 3 + inner + "</div>"
    assert (len(content(page).split("\n")) > 2) == kept


def test_threshold_changes_the_result():
    page = f"<div><p>{LONG * 4}</p><h2>Heading</h2><div><div>Buy now</div></div></div>"
    kept = [len(content(page, t).split("\n")) for t in (0.0, 0.5, 0.9)]
    assert kept == [3, 2, 1]


HOSTILE = {"unclosed tags": "<a ", "unclosed quotes": '<a "', "both quotes": "<a \"'x",
           "deep": "<div>x, y", "headings": "<h1>", "stray ends": "<p></div>", "brackets": "<",
           "comments": "<!--", "inline": "<span><p>", "ids": "<div id='i{}'><p>x, y.</p></div>",
           "classes": "<div class='{}'>x, y.</div>"}


@pytest.mark.parametrize("kind", HOSTILE)
def test_time_is_linear_on_hostile_pages(kind):
    def seconds(chars: int) -> float:
        part = HOSTILE[kind]
        page = "".join(part.format("abcdefghij"[i % 10] * (i % 199))
                       for i in range(chars // len(part)))
        t = time.process_time()
        content(page)
        return time.process_time() - t

    assert seconds(1_000_000) < 20                                  # quadratic: hours


def test_odd_pages(spark):
    rows = [(1, "u", "<p>a, b.</p>", "x"), (1, None, "<p>a, b.</p>", None), (None, "v", None, "y"),
            (2, "w", "<p>" + LONG * 20000 + "</p>", "z"), (3, "w", "<" * 5000, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(pages)
    assert got.columns == ["page_id", "url", "text", "_hx_text"]
    text = [r["_hx_text"] for r in got.collect()]
    assert sorted(map(len, text))[:3] == [0, 5, 5] and len(text) == 5
    assert html_extract.extract(pages.limit(0)).count() == 0
