import pytest
from pyspark.sql import functions as F

from martloom.llm.pages import host_of, main_texts, parse, paths_of_hosts

LAYOUT = "page_id LONG, url STRING, html STRING"
MENU = '<nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy &amp; save</div>'
END = '<aside>side</aside><div id="comments"><p>reader</p></div><form>f<p>g</p></form><footer>&copy; x</footer></body></html>'


def page(body, head=MENU):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>{head}{body}{END}'


@pytest.mark.parametrize("body, text", [
    ("<article><h1>A &lt;b&gt;</h1><p><b>One.<br><p>Two\n  three&nbsp;x</p></article>", "A <b>\nOne.\nTwo three x"),
    ("<div class='post-17'><header><h1>Site</h1></header><p>a<p>b</div>", "a\nb"),
    ("<article><header><h1>Own</h1></header><p>x</p><div class='share'>s</div>y</article>", "Own\nx\ny"),
    ("<main><ul><li>one<li>two</ul><table><tr><td>c1<td>c2<tr><td>d</table></main>", "one\ntwo\nc1\nc2\nd"),
    ("<div><p>x<!-- <p>no</p> --><script>if(a<b){}</script>y <i>z</i>w</p></div>", "xy zw"),
    ("plain <b>text</b> only", "plain text only"),
    ("<div title='a>b' data-x=\"<p>\">q</div>", "q"),
    ("<p>2 < 3 and a&amp;b &amp;am; &#233;", "2 < 3 and a&b &am; é"),
    ("<div class=cookie-notice>no</div><div class=content>yes</div>", "yes"),
    ("<select><option>a<option>b</select><p>z</p><textarea>t</textarea>", "z"),
])
def test_texts_of_pages(body, text):
    found = parse(page(body))
    assert found.text(None) == text


@pytest.mark.parametrize("source", ["", "<", "<p", "<script>", "a</p></b><b", "<p class='", "<!-- x", "<" * 2000, "<a b='" * 800, "<p>" * 3000])
def test_broken_pages_end(source):
    assert parse(source).text(None) is not None


def test_hosts(spark):
    cases = {"http://A.b/c": "a.b", "https://u:p@x.y:80/?q": "x.y", "x": "", "": "", "http://": "", "ftp://h#f": "h"}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()] + [(None, "")], "u STRING, h STRING")
    assert rows.filter(host_of(F.col("u")) != F.col("h")).count() == 0


def test_a_host_outvotes_a_page(spark):
    """A page whose longest part lies deeper than usual is read by the path of its host; alone it keeps its whole text too."""
    usual = "<div class='story-1'><div class='body'><p>Some text that goes on.</p><p>And on.</p></div></div>"
    odd = "<div class='story-2'><div class='body'><div><p>" + "long " * 90 + "</p></div><p>short end</p></div></div>"
    rows = [(i, "http://a.com/x", page(usual)) for i in range(9)] + [(50, "http://a.com/y", page(odd)), (51, "http://b.com/y", page(odd))]
    got = {r.page_id: r for r in main_texts(spark.createDataFrame(rows, LAYOUT)).collect()}
    assert got[50].text.endswith("\nshort end") and got[50].path == "/html/body/div.story-#/div.body"
    assert got[51].text == got[50].text
    assert got[3].text == "Some text that goes on.\nAnd on."


def test_several_paths_of_one_host_and_a_rare_one(spark):
    kinds = ["<article><p>art</p></article>", "<div class=post><p>pst</p></div>"]
    rows = [(i, "http://a.com", page(kinds[i % 2])) for i in range(40)] + [(99, "http://a.com", page("<main><p>rare</p></main>"))]
    docs = spark.createDataFrame(rows, LAYOUT)
    (paths,) = [r.paths for r in paths_of_hosts(docs).collect()]
    assert sorted(paths) == ["/html/body/article", "/html/body/div.post"]
    assert {r.page_id: r.text for r in main_texts(docs).collect()} == {i: "pst" if i % 2 else "art" for i in range(40)} | {99: "rare"}


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://a", page("<p>x é 😀</p>")), (1, None, page("<p>y</p>")), (1, None, page("<p>y</p>"))]
    got = main_texts(spark.createDataFrame([(*r, 1, 2) for r in rows], LAYOUT + ", host INT, paths INT"))
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"]
    found = sorted([tuple(r)[:4] for r in got.collect()], key=str)
    assert found == sorted([(1, None, "", 0), (2, "", "", 0), (None, "http://a", "x é 😀", 5), (1, None, "y", 1), (1, None, "y", 1)], key=str)
    assert main_texts(spark.createDataFrame([], LAYOUT)).collect() == []
