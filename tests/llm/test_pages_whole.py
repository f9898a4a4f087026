"""Pages come out whole: nothing is lost to a dominant part, nor to a class of a wrapper."""

import pytest

from martloom.llm.pages import main_texts, parse

LAYOUT = "page_id LONG, url STRING, html STRING"
LONG = "<p>" + "long text " * 40 + "</p>"


def text_of(body):
    return parse(f"<html><body>{body}</body></html>").text(None)


@pytest.mark.parametrize("body, first, last", [
    (f"<article><h1>Title</h1><p>lead</p><div class=body>{LONG}</div></article>", "Title", "text"),
    (f"<article><ul><li>{LONG}</ul><p>after</p></article>", "long", "after"),
    (f"<div class=entry><blockquote>{LONG}</blockquote><table><tr><td>cell</table></div>", "long", "cell"),
    (f"<h1>Title</h1><div><div>lead</div><div>{LONG}</div></div><p>end</p>", "Title", "end"),
    (f"<main><div>{LONG}</div><ul><li><a href=x>source</a></ul></main>", "long", "source"),
    (f"<div><a name=top>intro</a><div>{LONG}</div></div>", "intro", "text"),
])
def test_nothing_of_an_article_is_left_outside(body, first, last):
    words = text_of(body).split()
    assert (words[0], words[-1]) == (first, last)


def test_lists_of_links_stay_outside():
    assert text_of(f"<ul><li><a href=x>One</a><li><a href=y>Two</a></ul><div>{LONG}</div>").split()[0] == "long"


def test_a_host_that_agrees_on_the_inner_part_loses_nothing(spark):
    body = f"<article><h1>Title</h1><p>lead</p><div class=body>{LONG}</div></article>"
    inner = f"<article><div class=body>{LONG}</div></article>"
    rows = [(i, "http://a.com/x", inner) for i in range(30)] + [(i, "http://b.com/x", body) for i in range(40, 44)] + [(99, "http://a.com/y", body)]
    docs = spark.createDataFrame([(i, u, f"<html><body>{b}</body></html>") for i, u, b in rows], LAYOUT)
    got = {r.page_id: r.text for r in main_texts(docs).collect()}
    assert all(got[i].startswith("Title\nlead\nlong") for i in (40, 41, 42, 43, 99)) and got[3].startswith("long")


@pytest.mark.parametrize("body, text", [
    ("<div class='content-sidebar-wrap'><p>a text</p></div><div class=sidebar>no</div>", "a text"),
    ("<div class='with-sidebar'><p>a text</p></div><div id=left-sidebar>no</div>", "a text"),
    ("<article class='post tag-newsletter category-ads'><p>a</p></article>", "a"),
    ("<div class='sidebar'><article><p>a</p></article><div class='share-buttons'>no</div></div><p>b</p>", "a\nb"),
    ("<div class='banner'><p>" + "most " * 20 + "</p></div><p>b</p>", ("most " * 20).strip() + "\nb"),
    ("<div class='related'><p>only text</p></div>", "only text"),
    ("<p><span class='promo'>only text</span></p>", "only text"),
    ("<p>a</p><div id=comments><article class='comment'><p>" + "reader " * 20 + "</p></article></div>", "a"),
    ("<p>a text</p><div class='related-posts'>no</div><div class='site-header'>no</div><ul class='nav-links'><li>no</ul>", "a text"),
])
def test_marks_do_not_take_wrappers_and_articles(body, text):
    assert text_of(body) == text
