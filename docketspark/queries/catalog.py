"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.functions import forms, identifiers, urls
from docketspark.operators import documents, entities, fetch, hooks, selection, text_search
from docketspark.operators import index as index_ops
from docketspark.plans.check import check_changes, check_in_place, check_index
from docketspark.plans.obtain import keep, not_yet_kept, obtain, of_new_filings
from docketspark.plans.retrieve import request_rejects as retrieval_rejects
from docketspark.plans.retrieve import requested_filings, retrieve, retrieved_index
from docketspark.plans.watch import archive_catalog, new_filings
from docketspark.queries import feeds
from docketspark.session import scratch_dir, spread
from docketspark.sinks.index_table import (
    append_index,
    compact_index,
    read_index,
    stored_entries,
    write_file_number_index,
)
from docketspark.sinks.manifest_table import read_snapshot, snapshot_difference, write_snapshot
from docketspark.sinks.tables import (
    read_documents,
    write_documents,
    write_facts,
    write_security_csv,
    write_ticker_map,
)
from docketspark.sinks.text_index import read_text_index, write_text_index
from docketspark.sources import archive_source as archive_format
from docketspark.sources import archives, blocks, index_files, search, securities, submissions
from docketspark.sources import entities as entity_files
from docketspark.sources import facts as fact_files
from docketspark.sources.files import list_stored_files, locate, stored_files_of
from docketspark.streaming.index_stream import (
    documents_to_index,
    stream_documents,
    stream_submissions,
    stream_to_index,
)
from docketspark.streaming.live_feed import (
    read_feed,
    without_repeats,
    write_feed,
    write_keyed_feed,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AFTER = "2000-06-01"
BEFORE = "2000-12-31"
# Share of the documents that tells where ranges of stored facts end.
FACTS_SHARE = 0.002
TEXT_QUERY = 'The "in the" ER'


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _dated(df: DataFrame, *names: str) -> DataFrame:
    """Dates as text, the same in every engine."""
    return df.withColumns({name: F.col(name).cast("string") for name in names or ["filing_date"]})


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = feeds.submission_documents(spark, sf_dir)
    return submissions.explode_submissions(submissions.parse_submissions(docs))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_hits(
        search.parse_search_results(feeds.search_documents(spark, sf_dir))
    )


def _tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.ticker_map(
        entity_files.ticker_records(feeds.ticker_documents(spark, sf_dir))
    )


_FILING = ["cik", "form_type", "accession_number", "main_file_name", "filing_date"]


@query
def submissions_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _catalog(spark, sf_dir)
    return _dated(rows.select(*_FILING, F.get("file_num", 0).alias("file_number")))


@query
def submissions_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with arrays of unequal length: those of keys ending in 3 lose one."""
    docs = feeds.submission_documents(spark, sf_dir)
    emptied = F.regexp_replace("v", r'"fileNumber":\[[^\]]*\]', '"fileNumber":[]')
    text = F.when(F.col("cik").endswith("3"), emptied).otherwise(F.col("v"))
    broken = docs.select(text.alias("v"))
    return submissions.malformed_submissions(submissions.parse_submissions(broken))


@query
def newer_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.newer_filings(_catalog(spark, sf_dir), AFTER, ["10-K", "10-K/A", "S-1"])
    return _dated(rows.select(*_FILING))


@query
def newer_filings_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.newer_filings(feeds.catalog(spark, sf_dir), AFTER)
    return _dated(selection.filings_per_company(rows), "first_date", "last_date")


@query
def newest_n_per_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.newest_per_group(_catalog(spark, sf_dir), ["cik", "form_type"], 3)
    base = urls.filing_base_url("cik", "accession_number")
    return _dated(rows.select(*_FILING, "rank", base.alias("base_url")))


@query
def newest_n_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More filings per group than Spark limits before a shuffle; a third have no company."""
    rows = feeds.catalog(spark, sf_dir)
    nobody = F.col("accession_number").cast("bigint") % 3 == 0
    rows = rows.withColumn("cik", F.when(~nobody, F.col("cik")))
    ranked = selection.newest_per_group(rows, ["cik", "form_type"], 1001)
    return _dated(ranked.select(*_FILING, "rank"))


@query
def filing_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each filing stands in its document."""
    return _catalog(spark, sf_dir).select("accession_number", F.col("pos").cast("bigint").alias("pos"))


@query
def catalog_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission documents read from files, and their catalog written and read again."""
    root = scratch_dir(spark, "catalog")
    feeds.submission_documents(spark, sf_dir).select("v").write.text(f"{root}/documents")
    docs = submissions.read_submissions(spark, f"{root}/documents", multi_line=False)
    submissions.write_catalog(submissions.explode_submissions(docs), f"{root}/catalog")
    return _dated(spark.read.parquet(f"{root}/catalog").select(*_FILING))


@query
def submissions_with_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies put together from main documents and older blocks, of which some are missing
    and some not named."""
    main, older = feeds.sharded_submissions(spark, sf_dir)
    found = blocks.all_filings(blocks.parse_main(main), blocks.parse_blocks(older, "name"))
    return _dated(found.select(*_FILING, F.get("file_num", 0).alias("file_number"), "older"))


@query
def submission_blocks_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, older = feeds.sharded_submissions(spark, sf_dir)
    return blocks.block_report(blocks.parse_main(main), blocks.parse_blocks(older, "name"))


@query
def newest_n_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(selection.newest(feeds.catalog(spark, sf_dir), 100).select(*_FILING))


@query
def filings_of_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = feeds.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    wanted = wanted.select(F.col("c_custkey").alias("cik"))
    rows = selection.of_companies(feeds.catalog(spark, sf_dir), wanted)
    return _dated(rows.select(*_FILING))


_META = ["form_type", "accession_number", "cik", "base_url", "main_file_name", "xsl", "file_num"]


@query
def search_hits_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = search.hit_metadata(_hits(spark, sf_dir)).select(*_META, "filing_date")
    return _dated(rows.withColumn("file_num", F.array_join("file_num", "|")))


@query
def search_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_rejects(
        search.parse_search_results(feeds.search_documents(spark, sf_dir))
    )


@query
def search_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result documents cut at some place of their own, or with their parts named otherwise,
    are rejects too; whole ones are not."""
    docs = spread(feeds.search_documents(spark, sf_dir).select("v"))
    cut = F.left("v", (F.length("v") * 0.2 + F.pmod(F.xxhash64("v"), F.length("v") / 2)).cast("int"))
    renamed = F.regexp_replace("v", '^\\{"(hits|error[a-zA-Z]*)"', '{"other"')
    variants = F.array(
        *[F.struct(F.lit(k).alias("kind"), t.alias("v")) for k, t in (("cut", cut), ("renamed", renamed), ("whole", F.col("v")))]
    )
    broken = docs.select(F.explode(variants).alias("d")).select("d.kind", "d.v")
    found = [
        search.search_rejects(search.parse_search_results(broken.where(F.col("kind") == kind).select("v")))
        .where("reason = 'neither hits nor an error'").select(F.lit(kind).alias("kind"), "reason")
        for kind in ("cut", "renamed", "whole")
    ]
    return reduce(DataFrame.unionByName, found).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


def _selected(hits: DataFrame) -> DataFrame:
    last = F.try_element_at("ciks", F.lit(-1)).alias("cik")
    return _dated(hits.select("hit_id", last, "file_type", "filing_date"))


@query
def search_no_amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(selection.select_hits(_hits(spark, sf_dir), "S-1", amendments=False))


@query
def search_with_amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(selection.select_hits(_hits(spark, sf_dir), "S-1"))


@query
def search_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = selection.select_hits(_hits(spark, sf_dir), ["10-K", "10-Q"], AFTER, BEFORE)
    return _selected(hits)


@query
def text_search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(feeds.table(spark, sf_dir, "documents"))
    found = docs.where(selection.matches_text("text", TEXT_QUERY))
    return found.select("doc_id", "lang", "source", "n_chars")


# Words and phrases, frequent and rare ones, some with signs inside.
INDEX_QUERIES = ['the', '"in the"', 'over "of the" a', 'und "in der"', 'terms-of-use', 'the THE "the"', "zzzz the"]


@query
def text_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several searches of one index of all documents, built in two batches."""
    docs = feeds.table(spark, sf_dir, "documents")
    table = f"{scratch_dir(spark, 'words')}/index"
    for batch, part in (("a", F.col("doc_id") % 2 == 0), ("b", F.col("doc_id") % 2 == 1)):
        write_text_index(spread(docs.where(part)), table, batch)
    index = read_text_index(spark, table)
    found = [
        text_search.search(index, text).select("doc_id", "n_matches", F.lit(text).alias("query"))
        for text in INDEX_QUERIES
    ]
    return reduce(DataFrame.unionByName, found)


@query
def text_index_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index holds of every word: documents, occurrences, first and last place."""
    table = f"{scratch_dir(spark, 'words')}/index"
    write_text_index(spread(feeds.table(spark, sf_dir, "documents")), table, "a")
    return read_text_index(spark, table).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.size("places")).alias("n"),
        F.min(F.get("places", F.lit(0))).alias("first_place"),
        F.max(F.element_at("places", -1)).alias("last_place"),
    )


@query
def unknown_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame([("10-K",), ("10-Q",)], "form_type string")
    return selection.unknown_forms(feeds.catalog(spark, sf_dir), known)


@query
def unknown_forms_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with slips of the pen, and what they were most likely meant to be: the known
    names are the brands and types of parts."""
    part = feeds.table(spark, sf_dir, "part")
    known = part.select(F.explode(F.array("p_brand", "p_type")).alias("form_type")).distinct()
    key, name = F.col("p_partkey"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.col("p_type"))
    at = (key % 5 + 2).cast("int")
    written = (
        F.when(key % 4 == 0, F.concat(F.left("n", at), F.substring("n", at + 2, F.length("n"))))
        .when(key % 4 == 1, F.concat(F.left("n", at), F.lit("x"), F.substring("n", at + 1, F.length("n"))))
        .when(key % 4 == 2, F.lower("n"))
        .otherwise(F.concat(F.lit("zz-"), "n"))
    )
    forms = part.select(key, name.alias("n")).select(written.alias("form_type"))
    unknown = selection.unknown_forms(forms, known)
    return selection.nearest_known(unknown, known)


@query
def preferred_type_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.catalog(spark, sf_dir)
    # Some callers ask for a type, some leave it blank.
    asked = F.when(F.col("cik").endswith("1"), F.lit("txt")).when(F.col("cik").endswith("2"), "")
    return rows.select(
        "accession_number",
        "root_form",
        forms.preferred_type("root_form", asked).alias("preferred_type"),
        forms.preferred_type("form_type").alias("unmapped_type"),
        forms.is_amendment("form_type").alias("amendment"),
    )


def _plan(spark: SparkSession, sf_dir: str, preferred: Column | None, skip: bool) -> DataFrame:
    rows = feeds.catalog(spark, sf_dir)
    rows = rows.withColumn("base_url", urls.filing_base_url("cik", "accession_number"))
    rows = rows.drop("filing_date", "file_num")
    return fetch.plan_urls(rows, "root_form", preferred, skip)


_PLAN = [
    "cik",
    "accession_number",
    "main_file_name",
    "preferred_type",
    "file_url",
    "fallback_url",
    "skip",
]


@query
def url_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, None, False).select(*_PLAN)


@query
def url_plan_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.when(F.col("cik").endswith("3"), "txt").when(F.col("cik").endswith("4"), "html")
    return _plan(spark, sf_dir, asked, True).select(*_PLAN)


@query
def accession_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = fetch.plan_by_accession(feeds.catalog(spark, sf_dir))
    return plan.select("cik", "accession_number", "base_url", "file_url")


@query
def url_plan_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = fetch.to_fetch(_plan(spark, sf_dir, F.lit("htm"), True))
    return plan.select("cik", "accession_number", "file_url")


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir, None, False)
    return fetch.choose_available(plan, feeds.available(plan))


@query
def fetch_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fetched(spark, sf_dir).select(
        "accession_number", "fetched_url", "save_name", "used_fallback"
    )


@query
def fetch_no_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir, None, True)
    fetched = fetch.choose_available(plan, feeds.available(plan), skip_not_preferred=True)
    return fetched.select("accession_number", "fetched_url", "save_name", "used_fallback")


@query
def fetch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.fetch_summary(_fetched(spark, sf_dir))


@query
def ticker_map_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tickers(spark, sf_dir)


@query
def ticker_exchange_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_files.ticker_exchange(feeds.exchange_documents(spark, sf_dir))


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.resolve_companies(
        feeds.company_queries(spark, sf_dir), _tickers(spark, sf_dir)
    )


@query
def ticker_to_cik(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)


@query
def unresolved_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.unresolved(_resolved(spark, sf_dir))


@query
def xbrl_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _resolved(spark, sf_dir).where(F.col("cik").isNotNull())
    concept = urls.company_concept_url("cik", F.lit("us-gaap"), F.lit("AccountsPayableCurrent"))
    return rows.select(
        "q_id", urls.company_facts_url("cik").alias("facts_url"), concept.alias("concept_url")
    )


@query
def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = search.hit_metadata(_hits(spark, sf_dir))
    return _dated(index_ops.index_rows(rows))


_LOCATED = ["cik", "form_type", "file_number", "file_path", "filing_date", "accession_number"]


@query
def index_by_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = index_ops.of_form(feeds.index(spark, sf_dir), "S-1/A")
    return _dated(index_files.with_locations(rows, "/data").select(*_LOCATED))


@query
def index_by_cik(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = feeds.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    wanted = wanted.select(F.col("c_custkey").alias("cik"))
    rows = selection.of_companies(feeds.index(spark, sf_dir), wanted)
    return _dated(index_files.with_locations(rows, "/data").select(*_LOCATED))


@query
def file_number_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = index_ops.file_number_groups(feeds.index_with_repeats(spark, sf_dir))
    return _dated(rows, "first_date", "last_date")


@query
def file_number_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = index_ops.file_number_lists(feeds.index_with_repeats(spark, sf_dir))
    joined = F.transform("entries", lambda e: F.concat_ws(";", e["filing_date"], e["file_path"]))
    return rows.select(
        "cik",
        "file_number",
        "month",
        F.size("entries").cast("bigint").alias("n_entries"),
        F.array_join(joined, "|").alias("entries"),
    )


@query
def file_number_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = feeds.file_number_documents(spark, sf_dir)
    return _dated(index_files.parse_file_number_index(docs))


@query
def related_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = feeds.index(spark, sf_dir)
    # Everything related to an amended registration.
    requested = index_ops.of_form(index, "S-1/A")
    return _dated(index_ops.related_filings(index, requested))


@query
def sibling_filings_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blank file number is none: filings that have one are related to nothing."""
    index = index_ops.index_rows(feeds.blank_numbers(spark, sf_dir))
    rows = index_ops.related_summary(index).select("file_path", "file_number", "n_related")
    return rows


@query
def index_import_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index is imported from CSV; appending the same entries adds none."""
    root = scratch_dir(spark, "import")
    index = index_ops.index_rows(feeds.blank_numbers(spark, sf_dir))
    index.drop("cik").write.option("header", True).csv(f"{root}/csv")
    append_index(index_files.read_index_csv(spark, f"{root}/csv"), f"{root}/index", "000001")
    append_index(index, f"{root}/index", "000002")
    return _dated(read_index(spark, f"{root}/index"))


@query
def file_number_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported file-number index reads back."""
    path = scratch_dir(spark, "numbers")
    write_file_number_index(feeds.index_with_repeats(spark, sf_dir), path)
    lines = spark.read.text(path).select(F.col("value").alias("v"))
    return _dated(index_files.parse_file_number_index(lines))


@query
def index_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many batches merged into one, and a batch that runs again afterwards."""
    root = scratch_dir(spark, "compact")
    index = feeds.index_with_repeats(spark, sf_dir)
    part = F.pmod(F.xxhash64("file_path"), F.lit(3))
    for n in range(3):
        append_index(index.where(part == n), f"{root}/index", f"{n}")
    compact_index(spark, f"{root}/index", f"{root}/merged")
    append_index(index.where(part == 1), f"{root}/merged", "1")
    return _dated(read_index(spark, f"{root}/merged"))


@query
def sibling_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = index_ops.related_summary(feeds.index_with_repeats(spark, sf_dir))
    rows = rows.select("file_path", "file_number", "n_related", "first_date", "last_date")
    return _dated(rows, "first_date", "last_date")


@query
def index_check_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = feeds.index_with_repeats(spark, sf_dir)
    return _dated(index_ops.index_kept(index, feeds.manifest(spark, sf_dir)))


@query
def index_check_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = feeds.index_with_repeats(spark, sf_dir)
    return _dated(index_ops.index_removed(index, feeds.manifest(spark, sf_dir)))


@query
def index_check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = feeds.index_with_repeats(spark, sf_dir)
    return index_ops.check_report(index, feeds.manifest(spark, sf_dir))


@query
def index_check_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored index is checked against the stored files and written anew."""
    root = scratch_dir(spark, "check")
    append_index(feeds.index(spark, sf_dir), f"{root}/index", "000001")
    manifest = feeds.manifest(spark, sf_dir)
    where, _ = check_index(spark, f"{root}/index", manifest, f"{root}/checked")
    return _dated(read_index(spark, where))


_INDEX = ["cik", "form_type", "file_number", "file_path", "filing_date"]


def _index_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feeds.index_by_year``, written: a test of a path would build it anew at each mention."""
    rows = feeds.index_by_year(spark, sf_dir)
    rows.write.parquet(path := scratch_dir(spark, "by-year"))
    return spark.read.schema(rows.schema).parquet(path)


def _index_in_batches(rows: DataFrame, table: str) -> None:
    early = F.col("filing_date") < F.lit("1996-07-01").cast("date")
    append_index(rows.where(early), table, "000001")
    append_index(rows.where(~early), table, "000002")


@query
def index_check_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one year are missing: that year's folders are written anew, no other file."""
    table = f"{scratch_dir(spark, 'in-place')}/index"
    rows = _index_by_year(spark, sf_dir)
    _index_in_batches(rows, table)
    files = stored_entries(spark, table).select(F.col("_metadata.file_name").alias("file")).distinct()
    files.write.parquet(before := scratch_dir(spark, "files"))
    lost = F.col("file_path").rlike("/[0-9]{10}95[0-9]{6}/") & (feeds.order_in_path() % 3 == 0)
    check_in_place(spark, table, rows.where(~lost).select("file_path"))
    now = stored_entries(spark, table).select(*_INDEX, F.col("_metadata.file_name").alias("file"))
    old = spark.read.parquet(before).withColumn("old", F.lit(True))
    marked = now.join(old, "file", "left").withColumn("rewritten", F.col("old").isNull())
    return _dated(marked.drop("file", "old"))


@query
def manifest_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two listings that were kept."""
    table = scratch_dir(spark, "manifest")
    for name, listing in zip(("one", "two"), feeds.snapshots(spark, sf_dir)):
        write_snapshot(listing, table, name)
    found = snapshot_difference(*(read_snapshot(spark, table, name) for name in ("one", "two")))
    return _dated(found, "old_modified", "new_modified")


@query
def index_check_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check looks at removed files only where the last snapshot was checked."""
    table = f"{scratch_dir(spark, 'changes')}/index"
    old, new = feeds.snapshots(spark, sf_dir)
    rows = _index_by_year(spark, sf_dir)
    _index_in_batches(rows, table)
    listed = scratch_dir(spark, "manifest")
    write_snapshot(rows.join(old, "file_path", "left").select(
        "file_path", "length", "modified"), listed, "one")
    write_snapshot(new, listed, "two")
    last, now = (read_snapshot(spark, listed, name) for name in ("one", "two"))
    check_changes(spark, table, snapshot_difference(last, now), now, ["000001"])
    return _dated(read_index(spark, table))


@query
def index_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = feeds.index(spark, sf_dir)
    known = index.where(F.col("filing_date") < F.lit("1999-01-01").cast("date"))
    return _dated(index_ops.not_indexed(index, known))


@query
def index_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping appends, the second one run twice, and the table they leave."""
    index_table = scratch_dir(spark, "index")
    index = feeds.index_with_repeats(spark, sf_dir)
    early = index.where(F.col("filing_date") < F.lit("1999-01-01").cast("date"))
    append_index(early, index_table, "000001")
    append_index(index, index_table, "000002")
    append_index(index, index_table, "000002")
    return _dated(read_index(spark, index_table))


@query
def index_csv_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "csv")
    rows = feeds.index(spark, sf_dir).drop("cik")
    rows.write.option("header", True).csv(folder)
    return _dated(index_files.read_index_csv(spark, folder))


@query
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(feeds.table(spark, sf_dir, "pages")).withColumn("document", F.col("url"))
    return documents.extract_links(pages, ["page_id"], "html", "document")


@query
def page_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(feeds.table(spark, sf_dir, "pages"))
    return documents.rewrite_documents(pages, "html", "url").select("page_id", "html")


@query
def document_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as filed documents: HTML gets absolute links, other files stay as they are."""
    pages = spread(feeds.table(spark, sf_dir, "pages"))
    key = F.col("page_id")
    filed = pages.select(
        feeds.padded(key % 50, 10).alias("cik"),
        F.lit("8-K/A").alias("form_type"),
        feeds.padded(key, 18).alias("accession_number"),
        F.when(key % 2 == 0, "main.htm").otherwise("main.txt").alias("name"),
        "url",
        "html",
    )
    rewritten = documents.rewrite_documents(filed, "html", "url", "name")
    stored = documents.stored_documents(rewritten, "name", "html")
    return stored.select(
        "file_path",
        "cik",
        "form_type",
        "accession_number",
        F.md5("content").alias("content_md5"),
        F.col("content_length").cast("bigint").alias("content_length"),
    )


@query
def links_left_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' own links, some made to have a scheme or to stay within the document: those
    are left alone, others become absolute."""
    kind = F.col("page_id") % 4
    start = F.when(kind == 0, "mailto:a@b.example/").when(kind == 1, "#").when(kind == 2, "//other.example/")
    html = F.replace("html", F.lit('<a href="/'), F.concat(F.lit('<a href="'), start.otherwise("/")))
    pages = feeds.table(spark, sf_dir, "pages").select("page_id", html.alias("html"), "url")
    return documents.rewrite_documents(pages, "html", "url").select("page_id", "html")


@query
def document_store_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages stored, then some of them again with other content: the later one counts."""
    path = scratch_dir(spark, "store")
    key = F.col("page_id")
    pages = feeds.table(spark, sf_dir, "pages").select(
        feeds.padded(key % 50, 10).alias("cik"),
        F.lit("8-K").alias("form_type"),
        feeds.padded(key, 18).alias("accession_number"),
        F.lit("main.txt").alias("name"),
        "page_id",
        "html",
    )
    write_documents(documents.stored_documents(pages, "name", "html"), path, "1")
    later = pages.where(key % 3 == 0).withColumn("html", F.concat(F.lit("new "), "html"))
    for _ in range(2):  # the second batch runs again
        write_documents(documents.stored_documents(later, "name", "html"), path, "2")
    stored = read_documents(spark, path)
    return stored.select("file_path", F.md5("content").alias("content_md5"), "content_length")


@query
def ticker_map_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored map is replaced by a later one."""
    path = scratch_dir(spark, "tickers")
    write_ticker_map(_tickers(spark, sf_dir).limit(0), path)
    write_ticker_map(_tickers(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def security_csv_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "securities")
    write_security_csv(securities.security_rows(feeds.security_cells(spark, sf_dir)), path)
    return spark.read.schema("cusip string, issuer string, description string").csv(path)


@query
def facts_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored facts of one concept."""
    path = scratch_dir(spark, "facts")

    def facts(share: float) -> DataFrame:
        return fact_files.facts_long(fact_files.parse_company_facts(feeds.fact_documents(spark, sf_dir, share)))

    write_facts(facts(1.0), path, facts(FACTS_SHARE), FACTS_SHARE)
    return _facts(fact_files.concept_facts(spark.read.parquet(path), "dei", "Shares"))


_FACT = ["cik", "taxonomy", "tag", "unit", "end", "accn", "fy", "fp", "form"]


def _facts(rows: DataFrame) -> DataFrame:
    return rows.select(*_FACT, F.col("value").alias("val"))


@query
def facts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fact_files.parse_company_facts(feeds.fact_documents(spark, sf_dir))
    return _facts(fact_files.facts_long(docs))


@query
def company_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = feeds.fact_documents(spark, sf_dir)
    parsed = fact_files.parse_concept(docs, "us-gaap", "Revenues")
    return _facts(fact_files.company_concept(parsed, "us-gaap", "Revenues"))


@query
def facts_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts documents without their company, without their facts, cut, and sound ones."""
    docs = feeds.fact_documents(spark, sf_dir)
    key = F.regexp_extract("v", '"cik":([0-9]+)', 1).cast("bigint")
    docs = docs.withColumn("key", key)
    text = (
        F.when(F.col("key") % 4 == 0, F.regexp_replace("v", '"cik":[0-9]+,', ""))
        .when(F.col("key") % 4 == 1, F.replace("v", F.lit('"facts":'), F.lit('"fact":')))
        .when(F.col("key") % 4 == 2, F.left("v", (F.length("v") * 0.9 - F.pmod(F.xxhash64("v"), F.lit(100))).cast("int")))
        .otherwise(F.col("v"))
    )
    rejects = fact_files.facts_rejects(docs.select("key", text.alias("v")))
    return rejects.groupBy("key", "reason").agg(F.count(F.lit(1)).alias("n"))


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = feeds.zipped_pages(spark, sf_dir, scratch_dir(spark, "pages"))
    return archives.archive_contents(archives.archive_members(zips))


def _archive_name() -> Column:
    return identifiers.file_name("archive")


@query
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir).select(
        _archive_name().alias("archive"),
        "member",
        "part",
        F.length("content").cast("bigint").alias("length"),
        F.md5("content").alias("content_md5"),
    )


@query
def zip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives with what their members come to."""
    members = _members(spark, sf_dir)
    return members.groupBy(_archive_name().alias("archive")).agg(
        F.count_distinct("member").alias("n_members"),
        F.sum(F.length("content")).alias("length"),
    )


def _per_archive(members: DataFrame) -> DataFrame:
    return members.groupBy(_archive_name().alias("archive")).agg(
        F.count(F.lit(1)).alias("n_members"),
        F.sum(F.length("content")).alias("length"),
    )


@query
def archive_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same archives by the data source, in small byte ranges."""
    folder = scratch_dir(spark, "pages")
    feeds.zipped_pages(spark, sf_dir, folder)
    archive_format.register(spark)
    found = spark.read.format(archive_format.FORMAT).option("rangeBytes", 16 << 10).load(folder)
    return _per_archive(found)


@query
def archive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives arrive in three parts; the stream stops in between and goes on from its log."""
    folder, root = scratch_dir(spark, "pages"), scratch_dir(spark, "members")
    archive_format.register(spark)
    for part in range(3):
        feeds.zipped_pages(spark, sf_dir, folder, part)
        arriving = spark.readStream.format(archive_format.FORMAT).option("log", f"{root}/log").load(folder)
        run = arriving.writeStream.format("parquet").option("path", f"{root}/rows")
        run = run.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
    return _per_archive(spark.read.parquet(f"{root}/rows"))


@query
def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives as they are, without reading them."""
    folder = scratch_dir(spark, "pages")
    feeds.zipped_pages(spark, sf_dir, folder)
    listed = archives.list_archives(spark, folder)
    return listed.select(_archive_name().alias("archive"), (F.col("length") > 22).alias("filled"))


@query
def archive_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of archives of pages, read as submission documents: none is one."""
    zips = feeds.zipped_pages(spark, sf_dir, scratch_dir(spark, "pages"))
    members = archives.archive_members(zips)
    contents = archives.archive_contents(members, rejects=True)
    parsed = submissions.parse_submissions(
        archives.member_text(contents), name="member", keep=["archive"]
    )
    rejected = submissions.malformed_submissions(parsed, "archive", "name")
    return rejected.select(_archive_name().alias("archive"), F.col("name").alias("member"), "cik")


@query
def document_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of stored archives as documents next to them."""
    contents = _members(spark, sf_dir)
    key = F.substring_index(_archive_name(), ".", 1).cast("bigint")
    path = identifiers.relative_path(
        feeds.padded(key % 50, 10), F.lit("10-K"), feeds.padded(key, 18), _archive_name()
    )
    stored = documents.stored_members(contents.withColumn("archive", path))
    return stored.select(
        "file_path",
        "cik",
        "form_type",
        "accession_number",
        "member",
        F.md5("content").alias("content_md5"),
        "content_length",
    )


@query
def submissions_from_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = feeds.zipped_submissions(spark, sf_dir, scratch_dir(spark, "zips"))
    rows = archive_catalog(zips)
    return _dated(rows.select(*_FILING, F.get("file_num", 0).alias("file_number")))


@query
def thirteen_f_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    # Twenty-two years later as well: both folders of the list occur.
    day = F.col("o_orderdate").cast("date")
    days = F.explode(F.array(day, F.add_months(day, 264))).alias("day")
    return securities.security_list_urls(orders.select(days), "day")


@query
def thirteen_f_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = securities.security_rows(feeds.security_cells(spark, sf_dir))
    return rows.withColumn("cells", F.array_join("cells", "|", "~"))


@query
def identifier_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier functions on well-formed and odd values."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    raw_cik = (
        F.when(key % 4 == 0, text)
        .when(key % 4 == 1, F.concat(text, F.lit("12345678901")))
        .when(key % 4 == 2, F.concat(F.lit("T"), text))
        .otherwise("")
    )
    number = F.concat(F.lit("0000000001-20-"), feeds.padded(key, 6))
    name = (
        F.when(key % 5 == 0, F.concat(F.lit("htm"), text, F.lit(".htm")))
        .when(key % 5 == 1, F.lit(".hidden"))
        .when(key % 5 == 2, F.concat(F.lit("a.b/"), text))
        .when(key % 5 == 3, F.concat(F.lit("xsl/x"), text, F.lit(".tar.gz")))
        .otherwise("")
    )
    path = F.concat_ws("/", F.lit("disk"), F.lit("filings"), number, F.lit("R"), name)
    orders = feeds.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        identifiers.cik10(raw_cik).alias("cik"),
        identifiers.accession(number).alias("accession_number"),
        identifiers.file_name(name).alias("file_name"),
        identifiers.file_suffix(name).alias("suffix"),
        identifiers.accession_from_path(path).alias("path_accession"),
        identifiers.relative_path(F.lit("0000000001"), "o_orderstatus", number, name).alias("path"),
    )


@query
def filing_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user function over all filings, batch by batch."""

    def label(batch: pd.DataFrame) -> pd.DataFrame:
        text = batch["form_type"].str.lower() + "@" + batch["filing_date"]
        return pd.DataFrame({"accession_number": batch["accession_number"], "label": text})

    rows = _dated(feeds.catalog(spark, sf_dir).select(*_FILING))
    return hooks.map_filings(rows, label, "accession_number string, label string")


@query
def retrieve_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests -> companies -> hits -> newest three -> plan -> available address."""
    hits = _hits(spark, sf_dir)
    plan = _plan(spark, sf_dir, None, False)
    fetched = retrieve(
        feeds.requests(spark, sf_dir),
        _tickers(spark, sf_dir),
        hits,
        feeds.available(plan),
        number_of_filings=3,
    )
    request = ["request_cik", "request_form", "request_after", "request_before"]
    names = ["cik", "form_type", "accession_number", "fetched_url", "save_name", "used_fallback"]
    rows = fetched.select(*request, *names, "filing_date")
    return _dated(rows, "request_after", "request_before", "filing_date")


@query
def retrieve_to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows of everything retrieved when other types are skipped."""
    plan = _plan(spark, sf_dir, None, True)
    fetched = retrieve(
        feeds.requests(spark, sf_dir),
        _tickers(spark, sf_dir),
        _hits(spark, sf_dir),
        feeds.available(plan),
        number_of_filings=3,
        amendments=False,
        skip_not_preferred=True,
    )
    return _dated(retrieved_index(fetched))


@query
def retrieve_open_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More filings asked for than Spark limits before a shuffle, half the dates open."""
    found = requested_filings(
        feeds.requests(spark, sf_dir), _tickers(spark, sf_dir), _hits(spark, sf_dir), 1001
    )
    request = ["request_cik", "request_form", "request_after", "request_before"]
    counted = found.groupBy(*request).agg(
        F.count(F.lit(1)).alias("n"), F.min("filing_date").alias("first_date")
    )
    return _dated(counted, "request_after", "request_before", "first_date")


@query
def request_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = retrieval_rejects(feeds.requests(spark, sf_dir), _tickers(spark, sf_dir))
    return _dated(rejected, "after_date", "before_date")


@query
def retrieve_to_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests -> addresses in a wanted type -> landed files -> store and index, without
    what is indexed and stored; the rows of the store that the index refers to."""
    root = scratch_dir(spark, "retrieved")
    plan = _plan(spark, sf_dir, F.lit("htm"), False)
    # What a hit's text says is here the number of its filing.
    hits = _hits(spark, sf_dir).withColumn("text", F.col("hit_id"))
    fetched = retrieve(
        feeds.requests(spark, sf_dir), _tickers(spark, sf_dir), hits, feeds.available(plan),
        number_of_filings=3, preferred="htm", query='"0:d" 1',
    )
    kept = feeds.index(spark, sf_dir).where(F.col("cik").endswith("1"))
    fresh = not_yet_kept(fetched, kept, feeds.manifest(spark, sf_dir))
    # Stored, so that the retrieval is not computed for each sink and run.
    obtain(fresh, feeds.landed(fresh)).write.parquet(f"{root}/obtained")
    obtained = spark.read.parquet(f"{root}/obtained")
    for _ in range(2):  # a batch that runs again leaves the same
        keep(obtained, f"{root}/store", f"{root}/index", "1")
    stored = read_documents(spark, f"{root}/store")
    indexed = read_index(spark, f"{root}/index").select("file_path", "file_number")
    return stored.join(indexed, "file_path").select(
        "file_path", "cik", "form_type", "file_number", F.md5("content").alias("content_md5")
    )


@query
def watch_to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New filings are obtained, stored and indexed; the table they were missing from."""
    root = scratch_dir(spark, "watched")
    index = feeds.index(spark, sf_dir)
    append_index(index.where(F.col("file_number").isin("001-00000", "001-00003")), f"{root}/index", "0")
    known = read_index(spark, f"{root}/index")
    rows = of_new_filings(new_filings(_catalog(spark, sf_dir), known, AFTER, ["S-1", "S-1/A"]))
    keep(obtain(rows, feeds.landed(rows)), f"{root}/store", f"{root}/index", "1")
    stored = read_documents(spark, f"{root}/store").select("file_path", "content_length")
    return _dated(read_index(spark, f"{root}/index").join(stored, "file_path"))


@query
def watch_new_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer filings of tracked forms that the index does not hold."""
    index = feeds.index(spark, sf_dir)
    known = index.where(F.col("file_number").isin("001-00000", "001-00003"))
    rows = new_filings(_catalog(spark, sf_dir), known, AFTER, ["S-1", "S-1/A"])
    return _dated(rows)


@query
def stream_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive as files; the stream leaves each entry once in the table."""
    root = scratch_dir(spark, "stream")
    feeds.submission_documents(spark, sf_dir).select("v").write.text(f"{root}/documents")
    filings = stream_submissions(spark, f"{root}/documents", multi_line=False)
    stream_to_index(filings, f"{root}/index", f"{root}/checkpoint").awaitTermination()
    return _dated(read_index(spark, f"{root}/index"))


@query
def stream_new_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that repeats filings; each accession number comes out once."""
    root = scratch_dir(spark, "feed")
    docs = feeds.submission_documents(spark, sf_dir).select("v")
    docs.unionAll(docs.where(F.length("v") % 3 == 0)).write.text(f"{root}/documents")
    filings = stream_submissions(spark, f"{root}/documents", multi_line=False)
    feed = without_repeats(filings.select(*_FILING))
    write_feed(feed, f"{root}/feed", f"{root}/checkpoint").awaitTermination()
    schema = feed.select(*_FILING).schema
    return _dated(spark.read.schema(schema).parquet(f"{root}/feed"))


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the index stream cannot hold are beside the table: those of keys
    ending in 3 lost their file numbers."""
    root = scratch_dir(spark, "rejects")
    docs = feeds.submission_documents(spark, sf_dir)
    emptied = F.regexp_replace("v", r'"fileNumber":\[[^\]]*\]', '"fileNumber":[]')
    text = F.when(F.col("cik").endswith("3"), emptied).otherwise(F.col("v"))
    docs.select(text.alias("value")).write.text(f"{root}/documents")
    arriving = stream_documents(spark, f"{root}/documents", whole_files=False)
    query_run = documents_to_index(arriving, f"{root}/index", f"{root}/rejects", f"{root}/checkpoint")
    query_run.awaitTermination()
    rejected = spark.read.parquet(f"{root}/rejects").select("cik", F.lit("rejected").alias("kind"))
    held = read_index(spark, f"{root}/index").select("cik", F.lit("indexed").alias("kind"))
    return rejected.unionByName(held).groupBy("cik", "kind").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_feed_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that repeats filings, in any order and over several triggers: none is lost."""
    root = scratch_dir(spark, "keyed")
    docs = feeds.submission_documents(spark, sf_dir).select("v")
    docs.unionAll(docs.where(F.length("v") % 3 == 0)).write.text(f"{root}/documents")
    filings = stream_submissions(spark, f"{root}/documents", multi_line=False, files_per_trigger=6)
    feed = filings.select(*_FILING)
    write_keyed_feed(feed, f"{root}/feed", f"{root}/checkpoint").awaitTermination()
    return _dated(read_feed(spark, f"{root}/feed", feed.schema).select(*_FILING))


@query
def filing_callback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user function that writes a file for each filing, and the listing of those files."""
    root = scratch_dir(spark, "called")
    key = F.col("page_id")
    path = identifiers.relative_path(
        feeds.padded(key % 50, 10), F.lit("8-K"), feeds.padded(key, 18), F.lit("main.txt")
    )
    pages = feeds.table(spark, sf_dir, "pages").select(path.alias("file_path"), "url")

    def note(row: dict) -> None:
        system, place = locate(f"{root}/filings/{row['file_path']}")
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(place) as out:
            out.write(row["url"].encode())

    hooks.for_each_filing(pages, note)
    listed = list_stored_files(spark, root)
    by_folder = stored_files_of(pages, root).select("file_path", F.col("length").alias("again"))
    return listed.join(by_folder, "file_path").select("file_path", "length", "again")
