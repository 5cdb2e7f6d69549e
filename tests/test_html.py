from __future__ import annotations

import random
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import functions as F

from docketspark.functions import html as H
from docketspark.operators.documents import extract_links, rewrite_documents

BASE = "http://host/data/1/2/main.htm"
PAGE = """<!DOCTYPE html>
<!-- <a href="in/comment.htm">no</a> -->
<title><a href="in/title">no</a></title>
<script>var s = '<a href="in/script.htm">';</script>
<style>a { background: url(x) } <a href="in/style"></style>
<a href="../up.htm">up</a>
<A CLASS="x" HREF='single.htm' id=1>single</A>
<a href=bare.htm>bare</a><a href = "  spaced.htm ">spaced</a>
<a data-href="data.htm" title='href="t.htm"'>no address</a>
<a href="//other/x">protocol</a><a href="/root">root</a><a href="?q=1">query</a>
<a href="#frag">frag</a><a href="mailto:a@b.c">mail</a><a href="http://z/">absolute</a>
<a name="n"
   href="multi
line">multi</a><a href="">blank</a><a>none</a>
<img src="pic.gif" alt="a > b"><img src="http://z/pic.gif"/><img/src="slash.gif">
<article href="article.htm">not a link</article><link href="style.css">
<div title="<a href='in/attribute'>">text</div>
1 < 2 && 3 > 2 <a href="last.htm">unclosed"""


def rewritten(spark, pages, base=BASE):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    df = df.withColumn("base", F.lit(base))
    rows = rewrite_documents(df, "html", "base").orderBy("i").collect()
    return [row.html for row in rows]


def test_rewrite_touches_only_link_addresses(spark):
    expected = (
        PAGE.replace('"../up.htm"', '"http://host/data/1/up.htm"')
        .replace("'single.htm'", "'http://host/data/1/2/single.htm'")
        .replace("=bare.htm", '="http://host/data/1/2/bare.htm"')
        .replace('"  spaced.htm "', '"http://host/data/1/2/spaced.htm"')
        .replace('"//other/x"', '"http://other/x"')
        .replace('"/root"', '"http://host/root"')
        .replace('"?q=1"', '"http://host/data/1/2/main.htm?q=1"')
        .replace('"multi\nline"', '"http://host/data/1/2/multi\nline"')
        .replace('href="">blank', 'href="http://host/data/1/2/main.htm">blank')
        .replace('"pic.gif"', '"http://host/data/1/2/pic.gif"')
        .replace('"slash.gif"', '"http://host/data/1/2/slash.gif"')
        .replace('"last.htm"', '"http://host/data/1/2/last.htm"')
    )
    assert rewritten(spark, [PAGE]) == [expected]


def test_rewriting_twice_changes_nothing_more(spark):
    once = rewritten(spark, [PAGE])
    assert rewritten(spark, once) == once


def test_links_are_listed_in_order(spark):
    df = spark.createDataFrame([(1, PAGE, BASE)], "page_id int, html string, base string")
    rows = extract_links(df, ["page_id"], "html", "base").orderBy("link_no").collect()
    assert [row.address for row in rows] == [
        "../up.htm", "single.htm", "bare.htm", "spaced.htm", "//other/x", "/root", "?q=1", "#frag",
        "mailto:a@b.c", "http://z/", "multi\nline", "", "pic.gif", "http://z/pic.gif", "slash.gif",
        "last.htm",
    ]
    assert [row.tag for row in rows][-4:] == ["img", "img", "img", "a"]
    assert [row.link_no for row in rows] == list(range(16))


class Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.found = []

    def handle_starttag(self, tag, attrs):
        wanted = {"a": "href", "img": "src"}.get(tag)
        for name, value in attrs:
            if name == wanted:
                self.found.append((value or "").strip())
                return


def _pieces(rng):
    quote = rng.choice(['"', "'"])
    link = rng.choice(["x.htm", "/r/x", "../y", "#f", "z?a=b", "http://q/w"])
    return rng.choice(
        [
            f"<a href={quote}{link}{quote}>t</a>",
            f"<a class={quote}c{quote} href={quote}{link}{quote} id=i>t</a>",
            f"<img alt='x' src={quote}{link}{quote}>",
            f"<p title={quote}<a href=no>{quote}>text</p>",
            f"<!-- <a href={quote}{link}{quote}> -->",
            f"<script>'<a href={quote}{link}{quote}>'</script>",
            "a < b > c", "<br/>", "&amp;", "\n", "é", "<div>", "</div>", "<", ">", " ",
        ]
    )


def test_random_pages_agree_with_a_parser(spark):
    rng = random.Random(7)
    pages = ["".join(_pieces(rng) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    # A "<" right before a tag opens no tag, in either reading.
    pages = [page.replace("<<", "< <") for page in pages]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    tokens = df.select(
        "i",
        F.array_join(H.html_tokens("html"), "").alias("again"),
        F.transform(F.filter(H.html_tokens("html"), H.is_link_tag), H.link_address).alias("links"),
        H.rewrite_links("html", F.lit(BASE)).alias("rewritten"),
    )
    for row in tokens.collect():
        page = pages[row.i]
        assert row.again == page
        before, after = Links(), Links()
        before.feed(page)
        after.feed(row.rewritten)
        assert row.links == before.found
        assert after.found == [
            link if link.startswith("#") else urljoin(BASE, link) for link in before.found
        ]


def test_long_documents_do_not_exhaust_the_matcher(spark):
    word = "word & < " * 200_000
    tags = "<p class='c' title=\"t\">x</p>" * 50_000
    long_tag = "<a " + " ".join(f"a{i}='v'" for i in range(3000)) + " href='x'>"
    quoted = "<div title=\"" + "<a href='n'>" * 50_000 + '">'
    open_comment = "<!-- " + "<a href='n'>" * 50_000
    unclosed = "<script>" + "<a href='n'>" * 50_000
    pages = [word + "<a href='x'>", tags + "<a href='x'>", long_tag, quoted, open_comment, unclosed]
    got = rewritten(spark, pages)
    for page, new in zip(pages[:3], got[:3]):
        assert new == page.replace("href='x'", "href='http://host/data/1/2/x'")
    assert got[3:] == pages[3:]


def test_only_html_files_are_rewritten(spark):
    df = spark.createDataFrame(
        [("a.htm", "<a href='x'>"), ("a.html", "<a href='x'>"), ("a.txt", "<a href='x'>"), ("a.htm", None)],
        "name string, html string",
    ).withColumn("base", F.lit("http://host/"))
    rows = rewrite_documents(df, "html", "base", "name").collect()
    assert [row.html for row in rows] == [
        "<a href='http://host/x'>", "<a href='http://host/x'>", "<a href='x'>", None,
    ]
