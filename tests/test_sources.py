from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from docketspark.operators import entities
from docketspark.queries import feeds
from docketspark.sources import entities as entity_files
from docketspark.sources import facts as fact_files
from docketspark.sources import index_files, search, securities, submissions
from docketspark.sources.files import list_stored_files


def recent(**arrays):
    return {"filings": {"recent": arrays}}


GOOD = recent(
    form=["4", "S-1/A"],
    accessionNumber=["0000000001-20-000007", "000000000120000008"],
    filingDate=["2020-01-02", "not a date"],
    primaryDocument=["xsl/doc.xml", "a.htm"],
    fileNumber=["001-1", ""],
)


def test_submissions_become_rows_with_the_key_of_their_file(spark, tmp_path):
    (tmp_path / "CIK0000000012.json").write_text(json.dumps(GOOD, indent=1))
    (tmp_path / "CIK0000000013-submissions-001.json").write_text(json.dumps({"cik": "77", **GOOD}))
    docs = submissions.read_submissions(spark, str(tmp_path))
    rows = submissions.explode_submissions(docs).orderBy("cik", "pos").collect()
    assert [row.cik for row in rows] == ["0000000012"] * 2 + ["0000000077"] * 2
    assert [row.form_type for row in rows[:2]] == ["4", "S-1/A"]
    assert [row.accession_number for row in rows[:2]] == ["000000000120000007", "000000000120000008"]
    assert [row.main_file_name for row in rows[:2]] == ["doc.xml", "a.htm"]
    assert [str(row.filing_date) for row in rows[:2]] == ["2020-01-02", "None"]
    assert rows[0].file_num == ["001-1"]


def test_one_company_is_read_from_its_file_alone(spark, tmp_path):
    for key in (12, 13):
        (tmp_path / f"CIK{key:010d}.json").write_text(json.dumps(GOOD))
    docs = submissions.read_submissions(spark, str(tmp_path / "CIK0000000013.json"))
    assert [row.cik for row in docs.collect()] == ["0000000013"]


def test_malformed_documents_are_reported_not_cut(spark):
    short = json.loads(json.dumps(GOOD))
    short["filings"]["recent"]["fileNumber"] = ["001-1"]
    texts = [
        json.dumps({"cik": "1", **GOOD}),
        json.dumps({"cik": "2", **short}),
        json.dumps({"cik": "3", "filings": {}}),
        json.dumps({"cik": "T", **GOOD}),
        "{broken",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    docs = submissions.parse_submissions(df)
    assert {row.cik for row in submissions.explode_submissions(docs).collect()} == {"0000000001"}
    bad = submissions.malformed_submissions(docs).collect()
    assert len(bad) == 4
    assert {row.cik for row in bad} == {"0000000002", "0000000003", None}


def test_catalog_is_written_in_company_and_date_order(spark, tmp_path):
    df = spark.createDataFrame([(json.dumps({"cik": "1", **GOOD}),)], "v string")
    rows = submissions.explode_submissions(submissions.parse_submissions(df))
    submissions.write_catalog(rows, str(tmp_path / "catalog"))
    assert spark.read.parquet(str(tmp_path / "catalog")).count() == 2


def envelope(*hits):
    return json.dumps({"hits": {"hits": list(hits)}, "query": {"size": len(hits)}})


def hit(hit_id, **source):
    return {"_id": hit_id, "_source": source}


def test_hits_become_metadata(spark):
    texts = [
        envelope(
            hit(
                "0000000001-20-000007:dir:a.htm",
                ciks=["0000000001", "0000000002"],
                file_num=["001-1", "333-2"],
                xsl="",
                file_date="2020-01-02",
                form="",
                root_form="S-1/A",
                file_type="S-1/A",
            ),
            hit("noname", ciks=[], file_num=[], xsl="x", file_date="", form="4", root_form="4", file_type="4"),
        ),
        envelope(),
        json.dumps({"error": {"root_cause": [{"reason": "too broad"}]}}),
    ]
    results = search.parse_search_results(spark.createDataFrame([(t,) for t in texts], "v string"))
    rows = search.hit_metadata(search.search_hits(results)).orderBy("form_type").collect()
    assert len(rows) == 2
    second, first = rows
    assert first.accession_number == "000000000120000007"
    assert first.main_file_name == "dir:a.htm"
    assert first.cik == "0000000002"
    assert first.form_type == "S-1.A"
    assert first.xsl is None and second.xsl == "x"
    assert first.file_num == ["001-1", "333-2"]
    assert first.base_url.endswith("/edgar/data/0000000002/000000000120000007")
    assert second.cik is None and second.main_file_name is None and second.filing_date is None
    rejects = search.search_rejects(results).collect()
    assert [row.reason for row in rejects] == ["too broad"]


def test_last_ticker_record_wins_by_number_not_by_text(spark):
    text = json.dumps(
        {
            "9": {"cik_str": 9, "ticker": "AB"},
            "10": {"cik_str": 10, "ticker": "ab"},
            "2": {"cik_str": 2, "ticker": "CD"},
            "3": {"cik_str": 3, "ticker": None},
        }
    )
    records = entity_files.ticker_records(spark.createDataFrame([(text,)], "v string"))
    table = {row.ticker: row.cik for row in entities.ticker_map(records).collect()}
    assert table == {"AB": "0000000010", "CD": "0000000002"}
    asked = spark.createDataFrame(
        [("ab",), (" CD ",), ("zz",), ("12",), ("12345678901",), (None,)], "ticker_or_cik string"
    )
    resolved = entities.resolve_companies(asked, entities.ticker_map(records))
    got = {row.ticker_or_cik: row.cik for row in resolved.collect()}
    assert got == {
        "ab": "0000000010", " CD ": "0000000002", "zz": None, "12": "0000000012",
        "12345678901": "12345678901", None: None,
    }
    missing = entities.unresolved(resolved).collect()
    assert {row.ticker_or_cik for row in missing} == {"zz", None}


def test_exchange_columns_are_found_by_name(spark):
    texts = [
        json.dumps({"fields": ["cik", "name", "ticker", "exchange"], "data": [[1, "A", "TA", "NYSE"]]}),
        json.dumps({"fields": ["ticker", "cik"], "data": [["TB", 2], ["TC", None]]}),
        "{broken",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rows = entity_files.ticker_exchange(df).orderBy("ticker").collect()
    assert [tuple(row) for row in rows] == [
        ("0000000001", "A", "TA", "NYSE"), ("0000000002", None, "TB", None), (None, None, "TC", None),
    ]


FACTS = {
    "cik": 7,
    "entityName": "Seven",
    "facts": {
        "us-gaap": {
            "Assets": {
                "label": "Assets",
                "units": {
                    "USD": [
                        {"val": 12345678901234.5, "end": "2020-12-31", "accn": "a", "fy": 2020, "fp": "FY"},
                        {"val": -1, "end": "2021-12-31"},
                    ],
                    "EUR": [{"val": 3, "end": "2020-12-31"}],
                },
            },
            "Empty": {"units": {}},
        },
        "dei": {"Shares": {"units": {"shares": [{"val": 5, "end": "2020-12-31"}]}}},
    },
}


def test_facts_by_unit(spark, tmp_path):
    (tmp_path / "CIK0000000007.json").write_text(json.dumps(FACTS, indent=1))
    docs = fact_files.read_company_facts(spark, str(tmp_path))
    rows = fact_files.facts_long(docs).collect()
    assert len(rows) == 4
    values = {(row.taxonomy, row.tag, row.unit, row.end): float(row.val) for row in rows}
    assert values[("us-gaap", "Assets", "USD", "2020-12-31")] == 12345678901234.5
    assert values[("dei", "Shares", "shares", "2020-12-31")] == 5
    concept = fact_files.company_concept(docs, "us-gaap", "Assets", "7").collect()
    assert sorted(row.unit for row in concept) == ["EUR", "USD", "USD"]
    assert fact_files.company_concept(docs, "us-gaap", "Absent").count() == 0
    assert fact_files.company_concept(docs, "none", "Assets").count() == 0
    assert fact_files.company_concept(docs, "us-gaap", "Assets", "8").count() == 0


def test_ragged_security_rows(spark):
    cells = [
        (1, 0, ["c1", "*", "i1", "d1", "s1"]),
        (1, 1, ["c2", "", "i2", "d2"]),
        (2, 0, ["c3", "i3", "d3", "s3"]),
        (3, 0, ["c4", "i4"]),
        (4, 0, ["c5", "i5", "d5", "s5", "x", "y"]),
    ]
    df = spark.createDataFrame(cells, "table_id int, row_no int, cells array<string>")
    rows = {(r.table_id, r.row_no): r for r in securities.security_rows(df).collect()}
    named = {k: (r.cusip, r.issuer, r.description) for k, r in rows.items()}
    assert named[(1, 0)] == ("c1", "i1", "d1")
    assert named[(1, 1)] == ("c2", "i2", "d2")
    assert named[(2, 0)] == ("c3", "i3", "d3")
    assert named[(3, 0)] == ("c4", "i4", None)
    assert len(rows[(4, 0)].cells) == 6


def test_index_files(spark, tmp_path):
    (tmp_path / "0000000001.csv").write_text(
        "form_type,file_number,file_path,filing_date\n"
        "4,001-1,0000000001\\4\\000000000120000007\\a.xml,2020-01-02\n"
        '144,"001,2",0000000001/144/000000000120000008/b.htm,2020-01-03\n'
    )
    rows = index_files.read_index_csv(spark, str(tmp_path)).orderBy("filing_date").collect()
    assert [row.form_type for row in rows] == ["4", "144"]
    assert [row.cik for row in rows] == ["0000000001"] * 2
    assert rows[0].file_path == "0000000001/4/000000000120000007/a.xml"
    assert rows[1].file_number == "001,2"
    text = json.dumps({"001-1": [["4", "0000000001/4/000000000120000007/a.xml", "2020-01-02"]], "e": []})
    parsed = index_files.parse_file_number_index(spark.createDataFrame([(text,)], "v string"))
    assert [tuple(r) for r in parsed.collect()] == [tuple(rows[0])]
    located = index_files.with_locations(parsed, "/data").first()
    assert located.file_path == "/data/filings/0000000001/4/000000000120000007/a.xml"
    assert located.accession_number == "000000000120000007"


def test_stored_files_are_listed_without_reading_them(spark, tmp_path):
    folder = tmp_path / "filings" / "0000000001" / "4" / "000000000120000007"
    folder.mkdir(parents=True)
    (folder / "a.xml").write_text("abc")
    (tmp_path / "other.txt").write_text("not a filing")
    files = list_stored_files(spark, str(tmp_path))
    assert [(r.file_path, r.length) for r in files.collect()] == [
        ("0000000001/4/000000000120000007/a.xml", 3)
    ]
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split(">")[0]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from docketspark.session import scratch_dir

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.replace(".", "_"), default)

    class Session:
        conf = Conf(spark_master="yarn")

    with pytest.raises(ValueError):
        scratch_dir(Session(), "x")
    Session.conf = Conf(spark_master="yarn", spark_checkpoint_dir="hdfs://shared/")
    assert scratch_dir(Session(), "x").startswith("hdfs://shared/x-")


def test_fact_values_keep_all_digits(spark):
    values = ["0.123456789", "1e-8", "1" * 35, "-0.10", "12345678901234567890.123456789"]
    doc = '{"cik": 1, "facts": {"x": {"t": {"units": {"u": [%s]}}}}}' % ", ".join(f'{{"val": {v}}}' for v in values)
    docs = spark.createDataFrame([(doc,)], "v string")
    rows = fact_files.facts_long(fact_files.parse_company_facts(docs)).collect()
    assert [r.val for r in rows] == values
    assert [r.value for r in rows] == [float(v) for v in values]
    one = fact_files.company_concept(fact_files.parse_concept(docs, "x", "t"), "x", "t").collect()
    assert [r.val for r in one] == values


def test_documents_that_give_nothing_are_rejects(spark):
    texts = ["{cut", '{"message": "x"}', '{"hits": {"hits": []}}', '{"error": {"root_cause": [{"reason": "no"}]}}', '{"error": {}}']
    results = search.parse_search_results(spark.createDataFrame([(t,) for t in texts], "v string"))
    assert sorted(r.reason for r in search.search_rejects(results).collect()) == [
        "error without a reason", "neither hits nor an error", "neither hits nor an error", "no",
    ]
    docs = spark.createDataFrame([("{cut",), ('{"cik": 5}',), ('{"facts": {}}',), ('{"cik": 5, "facts": {}}',)], "v string")
    assert sorted(r.reason for r in fact_files.facts_rejects(docs).collect()) == [
        "no company key", "no facts", "not a facts document",
    ]


def test_rejected_documents_are_parsed_once(spark):
    docs = spark.createDataFrame([('{"cik": 5}',), (None,)], "v string").repartition(2)
    found = fact_files.facts_rejects(docs.select(F.concat("v", F.lit(" ")).alias("v")))
    assert sorted(r.reason for r in found.collect()) == ["no facts", "not a facts document"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_fact_documents_leave_out_nulls_and_quote_odd_numbers(spark, tmp_path):
    schema = (
        "l_suppkey bigint, l_orderkey bigint, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz"
    )
    day = datetime.datetime(1998, 5, 6)
    rows = [(7, 12, 5.0, 70.0, 0.04, float("nan"), "R", day), (None, None, None, float("inf"), -0.0, 1e-9, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = sorted((r.v for r in feeds.fact_documents(spark, str(tmp_path)).collect()), key=len)
    rest = '"end":"1998-05-06","accn":"000000000000000012","fy":1998,"fp":"Q2","form":"10-K"'

    def document(cik, facts):
        a, b, c, d, e, f, g = facts
        return (
            f'{{{cik}"facts":{{"us-gaap":{{"Revenues":{{"units":{{"USD":[{a},{b}]}}}},"UnitsSold":{{"units":{{"shares":[{c}]}}}}}},'
            f'"dei":{{"Rates":{{"units":{{"pure":[{d}],"USD":[{e}]}}}},"Shares":{{"units":{{"pure":[{f},{g}]}}}}}}}}}}'
        )

    first = ("70.0", "140.0", "5.0", "0.04", '"NaN"', "10.0", "5.0E-10")
    second = ('"val":"Infinity",', '"val":"Infinity",', "", '"val":-0.0,', '"val":1.0E-9,', '"val":"Infinity",', "")
    assert found == [
        document("", [f'{{{val}"form":"10-Q"}}' for val in second]),
        document('"cik":7,', [f'{{"val":{val},{rest}}}' for val in first]),
    ]
