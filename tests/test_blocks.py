"""Older blocks of a company's filings."""

import json

from docketspark.sources import blocks

FIELDS = ["form", "accessionNumber", "filingDate", "primaryDocument", "fileNumber"]


def block(*numbers):
    values = [["8-K", f"0000000001-20-{n:06d}", "2020-01-01", "a.htm", f"1-{n}"] for n in numbers]
    return dict(zip(FIELDS, map(list, zip(*values)))) if values else {f: [] for f in FIELDS}


def main(cik, recent, files):
    named = [{"name": n, "filingCount": c, "filingFrom": "x"} for n, c in files]
    return json.dumps({"cik": cik, "extra": 1, "filings": {"recent": recent, "files": named}})


def parsed(spark, mains, older):
    first = spark.createDataFrame([(v,) for v in mains], "v string")
    second = spark.createDataFrame(older, "name string, v string")
    return blocks.parse_main(first), blocks.parse_blocks(second, "name")


def numbers(rows):
    return sorted((r.cik, int(r.accession_number[-6:]), r.older) for r in rows.collect())


def test_a_company_is_put_together(spark):
    mains = [main("1", block(5, 6), [("b1.json", 2), ("b2.json", 1)]), main("2", block(9), [])]
    older = [("dir/b1.json", json.dumps(block(1, 2))), ("b2.json", json.dumps(block(3)))]
    docs = parsed(spark, mains, older)
    one, two = "0000000001", "0000000002"
    assert numbers(blocks.all_filings(*docs)) == [
        (one, 1, True), (one, 2, True), (one, 3, True), (one, 5, False), (one, 6, False), (two, 9, False)
    ]
    assert blocks.block_report(*docs).collect() == []


def test_a_filing_in_both_blocks_is_the_recent_one(spark):
    docs = parsed(spark, [main("1", block(5, 6), [("b", 2), ("b", 2)])], [("b", json.dumps(block(5, 4)))])
    assert numbers(blocks.all_filings(*docs)) == [("0000000001", 4, True), ("0000000001", 5, False), ("0000000001", 6, False)]


def test_what_does_not_fit_is_reported(spark):
    uneven = block(1, 2) | {"form": ["8-K"]}
    mains = [main("1", block(5), [("gone", 1), ("bad", 1), ("uneven", 2), ("short", 7), (None, 1)]), "no document", main("3", block(), [])]
    older = [("bad", "{cut"), ("uneven", json.dumps(uneven)), ("short", json.dumps(block(8))), ("extra", json.dumps(block(4))), ("null", None)]
    docs = parsed(spark, mains, older)
    assert numbers(blocks.all_filings(*docs)) == [("0000000001", 5, False), ("0000000001", 8, True)]
    assert {(r.cik, r.block, r.reason) for r in blocks.block_report(*docs).collect()} == {
        ("0000000001", "gone", "named and missing"),
        ("0000000001", "bad", "no well-formed block"),
        ("0000000001", "uneven", "no well-formed block"),
        ("0000000001", "short", "another number of filings than named"),
        (None, "extra", "present and not named"),
        (None, "null", "present and not named"),
    }


def test_no_documents(spark):
    docs = parsed(spark, [], [])
    assert blocks.all_filings(*docs).collect() == [] and blocks.block_report(*docs).collect() == []
