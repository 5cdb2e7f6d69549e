from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from docketspark.functions import forms
from docketspark.functions import identifiers as ids


def test_cik_is_padded_and_never_cut(values):
    given = ["1", "0000000012", "12345678901", " 7 ", "T1", "", None, "-5", "1_0"]
    expected = ["0000000001", "0000000012", "12345678901", "0000000007", None, None, None, None, None]
    assert values(ids.cik10, given) == expected


def test_accession_loses_dashes_unless_already_eighteen_long(values):
    given = ["0000000001-20-000007", "000000000120000007", "0000-0000012-00007", None]
    assert values(ids.accession, given) == [
        "000000000120000007",
        "000000000120000007",
        "0000-0000012-00007",
        None,
    ]


def test_file_name_and_suffix(values):
    given = ["xsl/a.xml", "a.htm", "htm1.htm", ".hidden", "noext", "a.b/c", "x.tar.gz", "", None]
    assert values(ids.file_name, given) == [
        "a.xml", "a.htm", "htm1.htm", ".hidden", "noext", "c", "x.tar.gz", "", None,
    ]
    assert values(ids.file_suffix, given) == ["xml", "htm", "htm", "", "", "", "gz", "", None]


def test_paths(values, spark):
    assert values(ids.safe_form, ["S-1/A", "4", None]) == ["S-1.A", "4", None]
    row = spark.range(1).select(
        ids.relative_path(
            F.lit("0000000001"), F.lit("S-1/A"), F.lit("0000000001-20-000007"), F.lit("a.htm")
        ).alias("p"),
        ids.absolute_path("/data/", F.lit("x/y")).alias("a"),
    ).first()
    assert row.p == "0000000001/S-1.A/000000000120000007/a.htm"
    assert row.a == "/data/filings/x/y"


def test_accession_from_path_takes_the_deepest_folder(values):
    number = "0000000001-20-000007"
    given = [
        "c/10-K/000000000120000007/a.htm",
        f"c/10-K/{number}/R/a.htm",
        "000000000000000001/000000000000000002/a.htm",
        "c\\10-K\\000000000120000007\\a.htm",
        "c/10-K/a.htm",
        "000000000120000007",
        None,
    ]
    assert values(ids.accession_from_path, given) == [
        "000000000120000007",
        "000000000120000007",
        "000000000000000002",
        "000000000120000007",
        None,
        None,
        None,
    ]


def test_preferred_type(values):
    given = ["10-K", "4", "10-K/A", "unheard of", None]
    assert values(forms.preferred_type, given) == ["xbrl", "xml", "htm", "htm", "htm"]
    asked = lambda x: forms.preferred_type(x, F.lit("txt"))
    assert values(asked, ["10-K", "4"]) == ["txt", "txt"]
    blank = lambda x: forms.preferred_type(x, F.lit(" "))
    assert values(blank, ["10-K", "4"]) == ["xbrl", "xml"]
    assert set(forms.PREFERRED_TYPE.values()) <= set(forms.DOCUMENT_TYPES)


def test_wanted_amendments_are_of_the_wanted_form(values):
    given = ["S-1", "S-1/A", "S-3/A", "S-3"]
    with_a = lambda x: forms.is_form(x, "S-1", True)
    without = lambda x: forms.is_form(x, "S-1", False)
    assert values(with_a, given) == [True, True, False, False]
    assert values(without, given) == [True, False, False, False]


@pytest.mark.parametrize(
    ("after", "before", "expected"),
    [
        ("2020-01-02", "2020-01-03", [False, True, True, False]),
        ("2020-01-02", "", [False, True, True, True]),
        (None, "2020-01-01", [True, False, False, False]),
        ("", None, [True, True, True, True]),
    ],
)
def test_date_range_is_inclusive_and_open_where_blank(values, after, before, expected):
    days = [str(datetime.date(2020, 1, 1) + datetime.timedelta(days=i)) for i in range(4)]
    test = lambda x: forms.within_dates(F.col(x).cast("date"), after, before)
    assert values(test, days) == expected
