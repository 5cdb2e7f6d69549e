from __future__ import annotations

import datetime
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from docketspark.functions import urls
from docketspark.sources.securities import security_list_address, security_list_urls

BASES = [
    "https://www.sec.gov/Archives/edgar/data/1/2/",
    "https://www.sec.gov/Archives/edgar/data/1/2/main.htm",
    "http://host",
    "http://host/",
    "http://host/a/b/c/d?q=1/2#f/g",
    "http://host?x=/y",
]
LINKS = [
    "x.htm", "./x.htm", "../x.htm", "../../x.htm", "../../../../../../x.htm", "/x", "/a/../b/./c",
    "//other/x", "?q", "x?y=../z", "x#../z", "..", ".", "../", "./", "a/..", "a/.", "x/",
    "/..", "/.", "g;x=1/../y", "", "...", "a.b/..c",
]
ALONE = ["#frag", "#", "mailto:a@b.c", "javascript:void(0)", "data:text/plain,x", "http://z/../q", "HTTPS://Z", "tel:1"]


def test_links_resolve_as_rfc_3986_says(spark):
    rows = [(base, link) for base in BASES for link in LINKS]
    df = spark.createDataFrame(rows, "base string, link string")
    got = df.select("base", "link", urls.resolve_url("base", "link").alias("url")).collect()
    for row in got:
        if row.link == "":
            assert row.url == row.base.split("#")[0]
            continue
        base = row.base + "/" if row.base == "http://host" and not row.link.startswith("?") else row.base
        expected = urljoin(base, row.link)
        if row.base == "http://host?x=/y" and row.link[0] not in "/?":
            expected = urljoin("http://host/", row.link)
        assert row.url == expected, (row.base, row.link)


def test_links_with_a_scheme_or_to_the_same_document_stay(spark):
    df = spark.createDataFrame([(link,) for link in ALONE], "link string")
    base = F.lit("http://host/a/b")
    for row in df.select("link", urls.resolve_url(base, "link").alias("url")).collect():
        assert row.url == row.link


def test_empty_segments_stay(values):
    base = F.lit("http://host/a/b")
    given = ["x//y", "/x//y", "x//../y"]
    assert values(lambda x: urls.resolve_url(base, x), given) == [
        "http://host/a/x//y", "http://host/x//y", "http://host/a/x/y",
    ]


def test_unusable_base_leaves_the_link(spark):
    row = spark.range(1).select(
        urls.resolve_url(F.lit(""), F.lit("x")).alias("a"),
        urls.resolve_url(F.lit(None).cast("string"), F.lit("x")).alias("b"),
    ).first()
    assert row.a == "x"


@pytest.mark.parametrize(
    ("name", "preferred", "skip", "expected"),
    [
        ("a.htm", "htm", False, "B/a.htm"),
        ("a.htm", "xbrl", False, "B/N-xbrl.zip"),
        ("a.htm", "xbrl", True, "B/N-xbrl.zip"),
        ("htm1.htm", "txt", True, "B/htm1.txt"),
        ("noext", "txt", False, "B/noext.txt"),
        ("a.html", "htm", True, "B/a.html"),
        ("a.htm", "html", True, "B/a.htm"),
        ("a.pdf", "htm", False, "B/a.pdf"),
        ("a.pdf", "htm", True, None),
        ("a.xml", "xml", True, "B/a.xml"),
        ("", "htm", True, None),
    ],
)
def test_file_url(spark, name, preferred, skip, expected):
    from docketspark.functions.identifiers import file_suffix

    lit = F.lit
    column = urls.file_url(
        lit("B"), lit("N"), lit(name), file_suffix(lit(name)), lit(preferred), skip
    )
    assert spark.range(1).select(column.alias("u")).first().u == expected


def test_security_list_address(spark):
    def address(*args):
        return spark.range(1).select(security_list_address(*args).alias("u")).first().u

    today = datetime.date(2023, 11, 5)
    assert address(None, None, today).endswith("/files/investment/13flist2023q4.pdf")
    assert address(2021, 1, today).endswith("/divisions/investment/13f/13flist2021q1.pdf")
    assert address(2021, 2, today).endswith("/files/investment/13flist2021q2.pdf")
    for wrong in [(2020, None), (None, 2), (2020, 5)]:
        with pytest.raises(ValueError):
            address(*wrong, today)


def test_security_list_urls_one_row_per_quarter(spark):
    days = [("2020-01-01",), ("2020-03-31",), ("2020-04-01",), (None,)]
    df = spark.createDataFrame(days, "d string")
    rows = security_list_urls(df, F.col("d").cast("date")).orderBy("quarter").collect()
    assert [(row.year, row.quarter) for row in rows] == [(2020, 1), (2020, 2)]


def test_concept_and_facts_addresses(spark):
    row = spark.range(1).select(
        urls.company_facts_url(F.lit("0000000001")).alias("f"),
        urls.company_concept_url(F.lit("0000000001"), F.lit("us-gaap"), F.lit("Assets")).alias("c"),
    ).first()
    assert row.f == "https://data.sec.gov/api/xbrl/companyfacts/CIK0000000001.json"
    assert row.c == "https://data.sec.gov/api/xbrl/companyconcept/CIK0000000001/us-gaap/Assets.json"
