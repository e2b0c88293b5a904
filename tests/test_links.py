"""Anchors of pages against the standard library's parser."""

from __future__ import annotations

import html.parser

from pyspark.sql import functions as F

from arrears.sources import pages


class Anchors(html.parser.HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found += [v or "" for k, v in attrs if k == "href"][:1]


def by_library(page):
    parser = Anchors()
    parser.feed(page or "")
    parser.close()
    return parser.found


ODD = [
    None,
    "",
    "<a href=plain.zip>x</a><A HREF = 'b.csv' >y</A><a\nhref\n=\n\"c d.csv\"/>",
    "<!-- <a href='no.zip'> --><a href='yes.zip'><!-- > <a href='no'> -- > --><a href=2.zip>",
    "<script>document.write(\"<a href='no.zip'>\")</script><style>a{}<a href=no></style><a href=s.zip>",
    "<img alt=\"<a href='no.zip'>\" src=x><a title='>' href='q.zip'>",
    "<a name=x><a><a href><a href=''><a data-href=no class=k href=one.zip HREF=two.zip>",
    "<abbr href=no.zip><area href=no.zip><a/href=slash.zip><a href=a/b/c.zip>",
    "<a href='x?a=1&amp;b=2'><a href=\"&#46;&#x2F;t&eacute;.zip\">",
    "2 < 3 <a href=late.zip> a<b <a href='end.zip'",
    "<SCRIPT type='a>b'>if (a<b) '<a href=no>'</SCRIPT ><a href=after.zip>",
]


def test_odd_pages(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "page_id int, html string")
    got = {r["page_id"]: list(r["found"] or []) for r in df.select("page_id", pages.hrefs(F.col("html")).alias("found")).collect()}
    resolved = spark.createDataFrame([(k, i, v) for k, vs in got.items() for i, v in enumerate(vs)], "k int, i int, v string")
    plain: dict[int, list[str]] = {k: [] for k in got}
    for r in resolved.select("k", "i", pages.unescaped("v").alias("v")).orderBy("k", "i").collect():
        plain[r["k"]].append(r["v"])
    assert plain == {k: by_library(page) for k, page in enumerate(ODD)}


def test_all_pages_of_the_table(spark, folder):
    df = spark.read.parquet(f"{folder}/pages.parquet")
    rows = df.select("html", pages.hrefs(F.col("html")).alias("found")).collect()
    assert sum(len(r["found"]) for r in rows) > 20
    for r in rows:
        assert list(r["found"]) == by_library(r["html"])


def test_long_pages_need_no_deep_stack(spark):
    df = spark.sql("""SELECT concat('<a ', repeat('x="y" ', 300000), 'href=in.zip>', repeat('<b>', 300000), '<a href=z.zip>',
                             '<!--', repeat('-', 300000), '<a href=no>') AS html""")
    assert df.select(pages.hrefs(F.col("html"))).first()[0] == ["in.zip", "z.zip"]


def test_parameters_are_no_references(spark):
    df = spark.createDataFrame([("a?x=1&copy=2&lt;&#65;&bogus;",), (None,)], "v string")
    assert [r[0] for r in df.select(pages.unescaped("v")).collect()] == ["a?x=1&copy=2<A&bogus;", None]


def test_text_elements_hold_no_anchors(spark):
    """By the HTML standard; the library's parser reads anchors inside of titles."""
    df = spark.createDataFrame([("<title><a href=no></title><textarea><a href=no></textarea><a href=yes>",)], "html string")
    assert df.select(pages.hrefs(F.col("html"))).first()[0] == ["yes"]
