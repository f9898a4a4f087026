"""Pages of a megabyte that repeat one thing, and broken ones, take time in proportion to their length."""

import time

import pytest

from martloom.llm.pages import parse

NESTED = "<div>" * 200_000


@pytest.mark.parametrize("source, text", [
    ("<a " * 350_000, "<a " * 349_999 + "<a"),
    ("x > y " + "<a " * 350_000, "x > y " + "<a " * 349_999 + "<a"),
    ("<![CDATA[" * 110_000, "<![CDATA[" * 110_000),
    ("<![CDATA[>" * 100_000 + "x", "x"),
    (NESTED + "deep", "deep"),
    ("<div>x" * 150_000, "\n".join(["x"] * 150_000)),
    ("<b>" * 100_000 + "<p>" * 100_000 + "y", "y"),
    ("<div>" * 100_000 + "</b>" * 100_000 + "z", "z"),
])
def test_a_megabyte_takes_seconds(source, text):
    began = time.process_time()
    page = parse(source)
    assert page.text(None) == text and page.text("/none") is None
    assert time.process_time() - began < 30


@pytest.mark.parametrize("source, text", [
    ("a<!-- b > c", "a"), ("a<b>b</b><!-- c", "ab"), ("a<!-->b", "a"), ("a<!---->b", "ab"), ("a<!-- > --><p>b", "a\nb"),
    ("a<![CDATA[b > c]]>d", "ab > cd"), ("a<![CDATA[b > c", "a c"), ("a<![CDATA[b", "a<![CDATA[b"), ("a<p", "a<p"), ("a > b < c", "a > b < c"),
])
def test_comments_and_sections_that_do_not_end(source, text):
    assert parse(source).text(None) == text


def test_a_deep_path_is_found_again():
    page = parse("<div class='a-1'>" * 3000 + "<div class='w-1/2'>end</div>")
    path = page.path(page.choice())
    assert path.endswith("/div.a-#/div.w-#/#") and path.count("/div") == 3001 and page.text(path) == "end"
