"""The positional index and its search, against a plain search of the texts."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketspark.operators.text_search import parsed, search
from docketspark.sinks.text_index import postings, read_text_index, write_text_index

SCHEMA = "doc_id bigint, text string"
WORDS = re.compile(r"[^\W_]+")


def plain(rows, query):
    """Documents whose words hold every phrase, with the number of places where one begins."""
    out = {}
    for doc_id, text in rows:
        words = WORDS.findall((text or "").lower())
        counts = [
            sum(words[i : i + len(p)] == p for i in range(len(words) - len(p) + 1)) for p in parsed(query)
        ]
        if doc_id is not None and counts and all(counts):
            out[doc_id] = sum(counts)
    return out


@pytest.fixture(scope="module")
def docs():
    return [
        (1, "The quick brown fox. The QUICK fox!"), (2, "quick the, the quick"), (3, None), (4, ""),
        (5, "10-K filed on 1999-12-31 by O'Neil"), (6, "the the the the"), (7, "Größe über alles, the end"),
        (None, "the quick"), (8, "the " * 5000 + "needle in the hay"), (9, "_under_score a_b"),
    ]


@pytest.mark.parametrize(
    "query",
    ["the", '"the quick"', "quick fox", '"the the"', "10-K", "O'Neil 1999", '"needle in the"', "GRÖSSE ÜBER",
     "über", "missing the", '""', "...", "", 'the "the" THE', '"quick the the"', "score a_b", '"the quick" brown'],
)
def test_search_is_that_of_the_texts(spark, tmp_path_factory, docs, query):
    table = str(tmp_path_factory.getbasetemp() / "words")
    if not (tmp_path_factory.getbasetemp() / "words").exists():
        write_text_index(spark.createDataFrame(docs[:5], SCHEMA), table, "1")
        write_text_index(spark.createDataFrame(docs[5:], SCHEMA), table, "2")
    found = search(read_text_index(spark, table), query).collect()
    assert {r.doc_id: r.n_matches for r in found} == plain(docs, query)
    assert len(found) == len({r.doc_id for r in found})


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    table = str(tmp_path / "words")
    rows = spark.createDataFrame([(1, "a b a"), (2, "b")], SCHEMA)
    for _ in range(2):
        write_text_index(rows, table, "1")
    found = {(r.term, r.doc_id): r.places for r in read_text_index(spark, table).collect()}
    assert found == {("a", 1): [0, 2], ("b", 1): [1], ("b", 2): [0]}


def test_an_index_that_was_not_written_is_empty(spark, tmp_path):
    assert search(read_text_index(spark, str(tmp_path / "none")), "a").collect() == []


def test_words_are_moved_once(spark):
    plan = postings(spark.createDataFrame([(1, "a")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_a_frequent_word_is_spread_over_files(spark, tmp_path):
    table = str(tmp_path / "words")
    rows = spark.range(20_000).selectExpr("id as doc_id", "concat('the w', id % 7) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_text_index(rows, table, "1")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.parquet(table)
    files = stored.where("term = 'the'").selectExpr("_metadata.file_name as f").groupBy("f").count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 15_000
    plan = search(read_text_index(spark, table), "the w3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in plan


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet='ab "-É\t1_', max_size=20))
def test_queries_are_phrases_of_words(query):
    phrases = parsed(query)
    assert all(p and all(WORDS.fullmatch(w) for w in p) for p in phrases)
    assert len({tuple(p) for p in phrases}) == len(phrases)


def test_texts_are_taken_apart_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def watched(frames):
        for frame in frames:
            seen.add(frame.num_rows)
            yield frame

    rows = spark.createDataFrame([(n, f"a b{n} a") for n in range(40)], SCHEMA)
    table = str(tmp_path / "words")
    write_text_index(rows.mapInArrow(watched, SCHEMA), table, "1")
    assert seen.value == 40
    assert read_text_index(spark, table).count() == 80


def test_documents_that_repeat_an_id_share_their_postings(spark, tmp_path):
    rows = [(1, "a b"), (1, "b a a"), (2, "a"), (None, "a"), (3, None)]
    for name, found in (("once", rows[1:]), ("twice", rows)):
        write_text_index(spark.createDataFrame(found, SCHEMA), str(tmp_path / name), "1")
    read = {n: {(r.term, r.doc_id): r.places for r in read_text_index(spark, str(tmp_path / n)).collect()} for n in ("once", "twice")}
    assert read["once"] == {("a", 1): [1, 2], ("b", 1): [0], ("a", 2): [0]}
    assert read["twice"] == {("a", 1): [0, 1, 2], ("b", 1): [0, 1], ("a", 2): [0]}
