from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from docketspark.functions.skew import group_sizes, hot_groups, join_hot
from docketspark.operators import documents, entities, fetch, hooks, selection
from docketspark.operators import index as index_ops
from docketspark.plans import retrieve as retrieval

FILING = "cik string, form_type string, accession_number string, main_file_name string, d string"


def filings(spark, rows):
    return spark.createDataFrame(rows, FILING).withColumn("filing_date", F.col("d").cast("date")).drop("d")


def test_newer_filings_keep_every_qualifying_row_in_any_order(spark):
    rows = [
        ("1", "4", "a", "x", "2019-12-31"),
        ("1", "4", "b", "x", "2020-01-01"),
        ("1", "S-3", "c", "x", "2021-01-01"),
        ("2", "4", "d", "x", "2020-01-01"),
        ("3", "4", "e", "x", None),
    ]
    df = filings(spark, rows)
    assert {r.accession_number for r in selection.newer_filings(df, "2020-01-01").collect()} == {"b", "c", "d"}
    tracked = selection.newer_filings(df, "2020-01-01", {"S-3"})
    assert [r.accession_number for r in tracked.collect()] == ["c"]
    assert selection.newer_filings(df, "2020-01-01", set()).count() == 0
    assert selection.newer_filings(df, "2022-01-01").count() == 0


def test_range_does_not_depend_on_the_order_of_hits(spark):
    rows = [("1", "4", n, "x", d) for n, d in [("a", "2022-01-01"), ("b", "2020-06-01"), ("c", "2018-01-01"), ("e", "2020-07-01")]]
    hits = filings(spark, rows).withColumn("file_type", F.col("form_type"))
    got = selection.select_hits(hits, "4", "2020-01-01", "2020-12-31")
    assert {r.accession_number for r in got.collect()} == {"b", "e"}


@pytest.mark.parametrize("limit", [1000, 2])
def test_newest_per_group_equals_sorting(spark, limit):
    rng = random.Random(1)
    rows = [
        (rng.choice(["hot", "hot", "a", "b", "c"]), "4", f"{i:018d}", "x", f"2020-01-{rng.randint(1, 9):02d}")
        for i in range(500)
    ]
    rows += [("n", "4", "0", "x", None), ("n", "4", "1", "x", "2020-01-01")]
    df = filings(spark, rows)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
    try:
        got = selection.newest_per_group(df, ["cik"], 5)
        plan = got._jdf.queryExecution().executedPlan().toString()
        ids = {r.accession_number for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert ("WindowGroupLimit" in plan) == (limit == 1000)
    expected = set()
    for cik in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == cik), key=lambda r: (r[4] or "", r[2]), reverse=True)
        expected |= {r[2] for r in mine[:5]}
    assert ids == expected


def test_text_query(values):
    given = ["Net Loss rose", "net income; loss", "NET LOSS", None, "etnetx loss"]
    words = lambda x: selection.matches_text(x, "net loss")
    phrase = lambda x: selection.matches_text(x, 'net "NET loss"')
    empty = lambda x: selection.matches_text(x, "")
    assert values(words, given) == [True, True, True, None, True]
    assert values(phrase, given) == [True, False, True, None, False]
    assert values(empty, given) == [True] * 5


def test_unknown_forms_count_amendments_with_their_form(spark):
    df = filings(spark, [("1", f, "a", "x", "2020-01-01") for f in ["4", "4/A", "X", "X/A", "X"]])
    known = spark.createDataFrame([("4",), ("4",)], "form_type string")
    assert [tuple(r) for r in selection.unknown_forms(df, known).collect()] == [("X", 3)]


def plan_of(spark, rows, **options):
    df = filings(spark, rows).withColumn("base_url", F.concat(F.lit("B/"), "accession_number"))
    return fetch.plan_urls(df, **options)


def test_fallback_is_used_only_when_it_exists_and_is_allowed(spark):
    rows = [("1", "10-K", n, "m.htm", "2020-01-01") for n in "abcd"]
    available = spark.createDataFrame(
        [(u,) for u in ["B/a/a-xbrl.zip", "B/a/m.htm", "B/b/m.htm", "B/b/m.htm", "B/d/other"]], "url string"
    )
    plan = plan_of(spark, rows)
    got = {r.accession_number: (r.fetched_url, r.save_name, r.used_fallback) for r in fetch.choose_available(plan, available).collect()}
    assert got == {
        "a": ("B/a/a-xbrl.zip", "a-xbrl.zip", False),
        "b": ("B/b/m.htm", "m.htm", True),
        "c": (None, None, None),
        "d": (None, None, None),
    }
    strict = fetch.choose_available(plan_of(spark, rows, skip_not_preferred=True), available, True)
    assert {r.accession_number: r.fetched_url for r in strict.collect()} == {
        "a": "B/a/a-xbrl.zip", "b": None, "c": None, "d": None,
    }


def test_skipped_rows_are_not_fetched(spark):
    rows = [("1", "S-1", "a", "m.pdf", "2020-01-01"), ("1", "S-1", "b", "m.htm", "2020-01-01")]
    plan = plan_of(spark, rows, skip_not_preferred=True)
    assert {r.accession_number: r.skip for r in plan.collect()} == {"a": True, "b": False}
    available = spark.createDataFrame([("B/a/m.pdf",), ("B/b/m.htm",)], "url string")
    got = fetch.choose_available(plan, available, True)
    assert [r.accession_number for r in got.collect()] == ["b"]


def test_two_documents_of_one_filing_are_two_plan_rows(spark):
    rows = [("1", "S-1", "a", "m.htm", "2020-01-01"), ("1", "S-1", "a", "n.htm", "2020-01-01")] * 2
    available = spark.createDataFrame([("B/a/m.htm",), ("B/a/n.htm",)], "url string")
    got = fetch.choose_available(plan_of(spark, rows), available)
    assert sorted(r.save_name for r in got.collect()) == ["m.htm", "n.htm"]
    summary = fetch.fetch_summary(got).first()
    assert (summary.n_files, summary.n_missing) == (2, 0)


INDEX = "cik string, form_type string, file_number string, file_path string, d string"


def index(spark, rows):
    return spark.createDataFrame(rows, INDEX).withColumn("filing_date", F.col("d").cast("date")).drop("d")


def test_index_rows_one_per_file_number(spark):
    df = filings(spark, [("0000000001", "S-1/A", "000000000120000007", "a.htm", "2020-01-01")])
    many = df.withColumn("file_num", F.array(F.lit("001-1"), F.lit("333-2"), F.lit("001-1")))
    none = df.withColumn("file_num", F.lit(None).cast("array<string>"))
    rows = index_ops.index_rows(many).collect()
    assert sorted(r.file_number for r in rows) == ["001-1", "333-2"]
    assert {r.file_path for r in rows} == {"0000000001/S-1.A/000000000120000007/a.htm"}
    assert {r.form_type for r in rows} == {"S-1.A"}
    assert [r.file_number for r in index_ops.index_rows(none).collect()] == [None]


def test_check_keeps_exactly_the_stored_files(spark):
    # A missing entry before and after a present one: each is judged on its own.
    rows = [("1", "4", "n", path, "2020-01-01") for path in ["A", "B", "C", "B", "B"]]
    rows += [("1", "4", "gone", "D", "2020-01-01"), ("2", "4", None, "E", "2020-01-01"), ("2", "4", None, "E", "2020-01-01")]
    df = index(spark, rows)
    manifest = spark.createDataFrame([("B",), ("B",), ("E",), ("Z",)], "file_path string")
    kept = index_ops.index_kept(df, manifest)
    assert sorted(r.file_path for r in kept.collect()) == ["B", "E"]
    assert sorted(r.file_path for r in index_ops.index_removed(df, manifest).collect()) == ["A", "C", "D"]
    report = {r.cik: r.asDict() for r in index_ops.check_report(df, manifest).collect()}
    assert report["1"] == {
        "cik": "1", "entries": 6, "duplicates_removed": 2, "missing_removed": 3,
        "entries_kept": 1, "file_numbers_dropped": 1,
    }
    assert report["2"]["duplicates_removed"] == 1 and report["2"]["file_numbers_dropped"] == 0
    again = index_ops.check_report(kept, manifest).agg(
        F.sum(F.col("duplicates_removed") + F.col("missing_removed")).alias("n")
    )
    assert again.first().n == 0


def test_index_lookups(spark):
    df = index(
        spark,
        [
            ("0000000001", "S-1.A", "001-1", "p", "2020-01-01"),
            ("0000000001", "4", "001-1", "q", "2020-01-02"),
            ("0000000001", "4", "001-2", "r", "2020-01-03"),
            ("0000000002", "4", "001-1", "s", "2020-01-04"),
            ("0000000002", "4", None, "t", "2020-01-04"),
        ],
    )
    paths = lambda d: sorted(r.file_path for r in d.collect())
    assert paths(index_ops.of_form(df, "S-1/A")) == paths(index_ops.of_form(df, "S-1.A")) == ["p"]
    assert paths(index_ops.of_company(df, "1")) == ["p", "q", "r"]
    assert paths(index_ops.of_file_number(df, "1", "001-1")) == ["p", "q"]
    assert paths(index_ops.of_file_number(df, "1", "unknown")) == []
    requested = spark.createDataFrame([("0000000001", "001-1")] * 2, "cik string, file_number string")
    assert paths(index_ops.related_filings(df, requested)) == ["p", "q"]
    summary = {r.file_path: (r.n_related, str(r.last_date)) for r in index_ops.related_summary(df).collect()}
    assert summary == {"p": (1, "2020-01-02"), "q": (1, "2020-01-02"), "r": (0, "2020-01-03"), "s": (0, "2020-01-04")}
    missing = index_ops.not_indexed(df, df.where(F.col("file_path").isin("p", "t")))
    assert paths(missing) == ["q", "r", "s"]


def test_lists_hold_one_month_each_at_any_size(spark):
    rows = [("1", "4", "hot", f"p{i}", f"2020-0{1 + i % 3}-01") for i in range(100)]
    rows += [("1", "4", "cold", "q", "2020-01-01"), ("1", "4", "cold", "r", None)]
    lists = index_ops.file_number_lists(index(spark, rows)).collect()
    hot = {r.month: [e.file_path for e in r.entries] for r in lists if r.file_number == "hot"}
    assert hot == {f"2020-0{m}": sorted(f"p{i}" for i in range(100) if i % 3 == m - 1) for m in (1, 2, 3)}
    assert {r.month for r in lists if r.file_number == "cold"} == {"2020-01", None}


def test_hot_groups_are_spread_and_the_join_stays_whole(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    right = left.select("k").distinct().withColumn("name", F.concat(F.lit("n"), "k"))
    sizes = group_sizes(left, ["k"])
    hot = hot_groups(sizes, ["k"], hot_rows=100).collect()
    assert [(r.k, r._parts) for r in hot] == [("hot", 10)]
    limits = {"hot_rows": 100}
    joined = join_hot(left, right, ["k"], ["v"], **limits)
    assert joined.columns == ["k", "v", "name"]
    got = joined.collect()
    assert len(got) == 3000 and len({r.v for r in got}) == 3000
    assert all(r.name == "n" + r.k for r in got)
    some = right.where(F.col("k").isin("hot", "1"))
    semi = join_hot(left, some, ["k"], ["v"], "left_semi", **limits)
    assert semi.columns == ["k", "v"] and semi.count() == 1001
    outer = join_hot(left, some, ["k"], ["v"], "left", sizes, **limits)
    assert outer.count() == 3000 and outer.where(F.col("name").isNotNull()).count() == 1001


def test_hot_null_keys_are_spread_and_kept_when_null_equals_null(spark):
    left = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    right = left.select("k").distinct().withColumn("name", F.coalesce(F.col("k"), F.lit(-1)))
    joined = join_hot(left, right, ["k"], ["v"], hot_rows=100, null_safe=True)
    assert joined.columns == ["k", "v", "name"]
    assert joined.count() == 900 and joined.where("k is null and name = -1").count() == 300
    assert join_hot(left, right, ["k"], ["v"], hot_rows=100).count() == 600
    assert join_hot(left, right, ["k"], ["v"], "left", hot_rows=100).count() == 900


def test_joins_start_no_job_while_they_are_put_together(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("put-together", "none")
    left = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
    join_hot(left, left.select("k").distinct(), ["k"], ["v"])
    assert not tracker.getJobIdsForGroup("put-together")
    spark.sparkContext.setJobGroup("tests", "tests")


def test_newest_of_groups_with_null_keys_beyond_the_limit(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "0000000001").alias("cik"),
        F.lit("4").alias("form_type"),
        F.format_string("%018d", "id").alias("accession_number"),
        F.lit("m.htm").alias("main_file_name"),
        F.date_add(F.lit("2000-01-01"), (F.col("id") / 3).cast("int")).alias("filing_date"),
    )
    for n in (3, 1000, 1001, 2500):
        got = selection.newest_per_group(rows, ["cik", "form_type"], n)
        assert {r.cik: r["count"] for r in got.groupBy("cik").count().collect()} == {None: n, "0000000001": n}
        assert got.agg(F.min("accession_number")).first()[0] == f"{6000 - 2 * n:018d}"


def test_ticker_ties_do_not_depend_on_order(spark):
    rows = [(5, "AB", "0000000001"), (5, "AB", "0000000002"), (None, "CD", "0000000003")]
    for order in (rows, rows[::-1]):
        records = spark.createDataFrame(order, "idx bigint, ticker string, cik string")
        assert {r.ticker: r.cik for r in entities.ticker_map(records).collect()} == {
            "AB": "0000000002", "CD": "0000000003",
        }


def test_the_plan_is_moved_once_to_choose_addresses(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.createDataFrame(
            [("a", f"https://h/{i}/p.zip", f"https://h/{i}/p.htm", False) for i in range(20)],
            "accession_number string, file_url string, fallback_url string, skip boolean",
        )
        urls = plan.select(F.col("fallback_url").alias("url"))
        chosen = fetch.choose_available(plan, urls)
        text = chosen._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 2
        assert all(r.used_fallback for r in chosen.collect()) and chosen.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_requests_of_many_companies(spark):
    requests = spark.createDataFrame(
        [
            ("ab", "S-1", "2020-01-01", None),
            ("AB", "S-1", "2020-01-01", None),
            ("ab", "S-1", "2019-01-01", "2019-12-31"),
            ("2", "S-1", None, None),
            ("zz", "S-1", None, None),
        ],
        "ticker_or_cik string, form_type string, a string, b string",
    ).select("ticker_or_cik", "form_type", F.col("a").cast("date").alias("after_date"), F.col("b").cast("date").alias("before_date"))
    tickers = spark.createDataFrame([("AB", "0000000001")], "ticker string, cik string")
    hits = [
        (f"{i:018d}:m.htm", ["0000000001", "0000000002"] if i % 2 else ["0000000001"], ["001-1"], "", f"20{19 + i % 3}-01-01", "S-1", "S-1", "S-1/A" if i == 5 else "S-1")
        for i in range(9)
    ] + [(f"{99:018d}:m.htm", ["0000000001"], [], "", "2021-01-01", "4", "4", "4")]
    columns = "hit_id string, ciks array<string>, file_num array<string>, xsl string, d string, form string, root_form string, file_type string"
    df = spark.createDataFrame(hits, columns).withColumn("filing_date", F.col("d").cast("date")).drop("d")
    got = retrieval.requested_filings(requests, tickers, df, 2, amendments=False).collect()
    by_request = {}
    for row in got:
        key = (row.request_cik, str(row.request_before))
        by_request.setdefault(key, []).append(int(row.accession_number))
    # Newest first; 5 is an amendment; 0, 3 and 6 are of 2019.
    assert {key: sorted(found) for key, found in by_request.items()} == {
        ("0000000001", "None"): [2, 8],
        ("0000000001", "2019-12-31"): [3, 6],
        ("0000000002", "None"): [1, 7],
    }


@pytest.mark.parametrize(("form", "amendments", "expected"), [
    ("S-1", True, [1, 2]), ("S-1", False, [1]), ("S-1/A", True, [2]), ("S-1/A", False, []),
])
def test_an_amendment_answers_requests_for_its_form_and_for_itself(spark, form, amendments, expected):
    requests = spark.createDataFrame(
        [("1", form, None, None)],
        "ticker_or_cik string, form_type string, after_date date, before_date date",
    )
    tickers = spark.createDataFrame([], "ticker string, cik string")
    columns = "hit_id string, ciks array<string>, file_num array<string>, xsl string, filing_date date, form string, root_form string, file_type string"
    hits = spark.createDataFrame(
        [
            (f"{n:018d}:m.htm", ["0000000001", "0000000001"], [], "", None, kind, "S-1", kind)
            for n, kind in [(1, "S-1"), (2, "S-1/A"), (3, "S-3/A")]
        ],
        columns,
    )
    got = retrieval.requested_filings(requests, tickers, hits, 10, amendments).collect()
    assert sorted(int(row.accession_number) for row in got) == expected


def test_hooks_see_every_filing(spark, tmp_path):
    df = filings(spark, [("1", "4", f"n{i}", "x", "2020-01-01") for i in range(20)])
    folder = str(tmp_path)

    def note(row):
        with open(f"{folder}/{row['accession_number']}", "w") as out:
            out.write(row["cik"])

    hooks.for_each_filing(df, note)
    assert len(list(tmp_path.iterdir())) == 20
    upper = hooks.map_filings(df, lambda batch: batch[["accession_number"]].apply(lambda s: s.str.upper()), "accession_number string")
    assert {r.accession_number for r in upper.collect()} == {f"N{i}" for i in range(20)}


def test_landed_files_are_stored_indexed_and_handed_on(spark, tmp_path):
    from docketspark.plans import obtain as job
    from docketspark.sinks.index_table import read_index
    from docketspark.sinks.tables import read_documents

    base = "https://h/Archives/1/n1"
    fetched = spark.createDataFrame(
        [
            ("0000000001", "S-1", "000000000120000001", "m.htm", base, f"{base}/m.htm", ["001-1", ""], None),
            ("0000000001", "S-1", "000000000120000002", "x.zip", base, f"{base}/x.zip", [" "], None),
            ("0000000001", "S-1", "000000000120000003", None, base, None, ["001-1"], None),
        ],
        "cik string, form_type string, accession_number string, save_name string, base_url string,"
        " fetched_url string, file_num array<string>, filing_date date",
    )
    landed = spark.createDataFrame(
        [(f"{base}/m.htm", bytearray(b'<a href="ex1.htm">e</a>')), (f"{base}/x.zip", bytearray(b"\xff\x00"))],
        "url string, content binary",
    )
    store, table = str(tmp_path / "store"), str(tmp_path / "index")
    notes = tmp_path / "notes"
    notes.mkdir()
    folder = str(notes)

    def note(row):
        with open(f"{folder}/{row['accession_number']}", "w") as out:
            out.write(row["save_name"])

    for _ in range(2):
        job.keep(job.obtain(fetched, landed), store, table, "1", note)
    stored = {r.file_path.rsplit("/", 1)[1]: bytes(r.content) for r in read_documents(spark, store).collect()}
    assert stored == {"m.htm": f'<a href="{base}/ex1.htm">e</a>'.encode(), "x.zip": b"\xff\x00"}
    index = read_index(spark, table)
    assert sorted((r.file_path.rsplit("/", 1)[1], r.file_number) for r in index.collect()) == [
        ("m.htm", "001-1"), ("x.zip", None),
    ]
    assert len(list(notes.iterdir())) == 2
    manifest = index.select("file_path").where(F.col("file_path").endswith("m.htm"))
    left = job.not_yet_kept(fetched, index, manifest)
    assert sorted(str(r.save_name) for r in left.collect()) == ["None", "x.zip"]


def test_document_store_rows_and_members(spark):
    df = filings(spark, [("0000000001", "10-K/A", "000000000120000007", "x.zip", "2020-01-01")])
    stored = documents.stored_documents(df.withColumn("content", F.lit("abc")), "main_file_name", "content")
    row = stored.first()
    assert row.file_path == "0000000001/10-K.A/000000000120000007/x.zip"
    assert bytes(row.content) == b"abc" and row.content_length == 3
    contents = spark.createDataFrame(
        [(row.file_path, "d/m.xml", 0, 0, bytearray(b"xy"))],
        "archive string, member string, position bigint, part int, content binary",
    )
    member = documents.stored_members(contents).first()
    assert member.file_path == "0000000001/10-K.A/000000000120000007/d/m.xml"
    assert member.content_length == 2 and member.cik == "0000000001"
    assert (member.form_type, member.accession_number) == ("10-K.A", "000000000120000007")


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
def test_nearest_known_forms_are_those_of_all_pairs(spark, most):
    known = ["10-K", "10-Q", "8-K", "S-1", "SC 13G", "SC 13D", "DEF 14A", "NT 10-K", "4", "424B3", "424B5", "", None]
    asked = ["10K", "10-KK", "8 K", "s-1", "SC13G", "SC 13", "DEF14A", "NT10-K", "44", "5", "424B", "X", "", None, "É-1", "10-k"]
    names = spark.createDataFrame([(n,) for n in known], "form_type string")
    forms = spark.createDataFrame([(n, 1) for n in asked], "form_type string, n_filings int")
    found = {r.form_type: (r.nearest, r.distance) for r in selection.nearest_known(forms, names, most).collect()}
    expected = {}
    for name in asked:
        pairs = [(plain_distance(name.upper(), k.upper()), k) for k in known if k is not None] if name is not None else []
        near = min((p for p in pairs if p[0] <= most), default=(None, None))
        expected[name] = (near[1], near[0])
    assert found == expected
    assert selection.nearest_known(forms.where("false"), names).collect() == []
