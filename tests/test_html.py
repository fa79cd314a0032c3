"""Nested elements, character references and main-content candidates of stored pages."""

import html as library
import random

import pytest
from pyspark.sql import functions as F

from rosterforge.functions import html
from rosterforge.operators import site

RICH = "We care for children every day of the week. " * 6


def texts(spark, pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, p string")
    opened = df.select("i", html.content_openings(html.body(F.col("p"))).alias("o"))
    return [r["t"] for r in opened.select("i", html.content_texts(F.col("o")).alias("t")).orderBy("i").collect()]


def test_nested_elements_close_where_they_should(spark):
    page = f'<html><body><div id="content"><div>{RICH}</div><p>More.</p></div><footer><div>Footer</div></footer></body></html>'
    got = site.page_texts(spark.createDataFrame([("http://a.com", page)], "url string, html string")).first()
    assert got["text"] == f"{RICH.strip()}\nMore."


def test_references_in_page_text(spark):
    page = f"<html><body><main>{RICH}Kids&#8217; &#x27;Mar&iacute;a&#x27; &Eacute;cole</main></body></html>"
    got = site.page_texts(spark.createDataFrame([("http://a.com", page)], "url string, html string")).first()
    assert got["text"].endswith("Kids’ 'María' École")


@pytest.mark.parametrize(
    "page, place, want",
    [
        ("<main>one<main>two</main>three</main>four", 0, "one\ntwo\nthree"),
        ("<ARTICLE class=x>a</article >b<article>c</article>", 1, "a"),
        ("<div id=x class='box content'><div>a</div><DIV>b <b> c</b></DIV>d</div>e", 3, "a\nb c\nd"),
        ("<span ID=content>a<span>b</span>c</span>d", 2, "abc"),
        ("<div class=\"main\">never closed<div>x</div>y", 5, "never closed\nx\ny"),
        ("<img id=content>x", 2, ""),
        ("<mainly>x</mainly>", 0, ""),
        ("<p data-id='content'>x</p>", 2, ""),
        ("<p id='Content'>x</p>", 2, ""),
        ("<p class='contents'>x</p>", 3, ""),
        ("<script>'<main>'</script><!-- <main> --><main>x</main>", 0, "x"),
        ("", 0, ""),
    ],
)
def test_candidates(spark, page, place, want):
    assert texts(spark, [page])[0][place] == want


def test_null_page(spark):
    df = spark.createDataFrame([("http://a.com", None), ("http://b.com", "")], "url string, html string")
    assert site.page_texts(df).count() == 0 and site.extract_links(df).count() == 0


def test_references_as_the_library_reads_them(spark):
    """Random strings of reference parts, each resolved once."""
    made = random.Random(3)
    parts = [
        "&", "amp", ";", "#", "x", "39", "8217", "1F600", "copy", "not", "notit", "&amp;", "&lt", "&nbsp;", "&#150;",
        "&#xD800;", "&#0;", "&#1114112;", "&#99999999999999999999;", "&CounterClockwiseContourIntegral;", "&fjlig;", " ", "z", "=",
    ]
    rows = ["".join(made.choice(parts) for _ in range(made.randrange(9))) for _ in range(400)] + ["", "plain"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    got = [r["d"] for r in df.select("i", html.decode(F.col("t")).alias("d")).orderBy("i").collect()]
    assert got == [library.unescape(t) for t in rows]
    fixed = ["&#39;", "&#8217;x", "&#x1F600;", "&#x27", "&#150;", "&#xD800;", "&#0;", "&#99999999999999999999;"]
    df = spark.createDataFrame([(t,) for t in fixed], "t string").coalesce(1)
    assert [r["d"] for r in df.select(html.decode(F.col("t")).alias("d")).collect()] == [library.unescape(t) for t in fixed]


def test_references_in_attributes(spark):
    page = '<a href="/x?a=1&copy=2&amp;b=&lt;&notit=3">1</a><img src="/i?p=1&reg=2&#x26;q">'
    df = spark.createDataFrame([(page,)], "p string")
    row = df.select(
        html.anchors(F.col("p")).alias("a"), html.image_source(html.image_tags(F.col("p"))[0]).alias("s")
    ).first()
    assert row["a"] == ["/x?a=1&copy=2&b=<&notit=3"] and row["s"] == "/i?p=1&reg=2&q"
