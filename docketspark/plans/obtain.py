"""Landed files of retrieved filings: links made absolute, stored, indexed, handed on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.functions.forms import HTML_SUFFIXES
from docketspark.functions.html import rewrite_links
from docketspark.functions.identifiers import (
    accession_from_path,
    file_name,
    file_suffix,
    relative_path,
)
from docketspark.functions.urls import filing_base_url
from docketspark.operators.documents import stored_documents
from docketspark.operators.hooks import for_each_filing
from docketspark.operators.index import index_rows
from docketspark.session import scratch_dir
from docketspark.sinks.index_table import append_index
from docketspark.sinks.tables import write_documents


def not_yet_kept(fetched: DataFrame, index: DataFrame, manifest: DataFrame) -> DataFrame:
    """Retrieved rows without those whose file is both indexed and still stored."""
    kept = index.select("file_path").join(manifest.select("file_path"), "file_path", "left_semi")
    path = relative_path("cik", "form_type", "accession_number", "save_name")
    known = kept.where("file_path is not null").distinct().withColumnRenamed("file_path", "_kept")
    # Rows without an address have no path; they stay and match nothing.
    rows = fetched.withColumn("_path", path)
    return rows.join(known, F.col("_path") == F.col("_kept"), "left_anti").drop("_path")


def of_new_filings(rows: DataFrame) -> DataFrame:
    """Rows of ``new_filings`` in the shape of retrieved ones."""
    accession = accession_from_path("file_path")
    return rows.withColumns(
        {
            "accession_number": accession,
            "save_name": file_name("file_path"),
            "base_url": filing_base_url("cik", accession),
            "fetched_url": F.col("file_url"),
            "file_num": F.array("file_number"),
        }
    ).drop("file_number")


def obtain(fetched: DataFrame, landed: DataFrame) -> DataFrame:
    """Retrieved rows with the ``content`` that landed for their address (``url, content``).

    Links of HTML files are resolved against the filing's folder, so against its address
    with a slash behind it; HTML that is not UTF-8 stays as it is. Rows whose file did not
    land are left out.
    """
    files = landed.select(F.col("url").alias("fetched_url"), "content")
    found = fetched.where("fetched_url is not null").join(files, "fetched_url")
    is_html = file_suffix("save_name").isin(HTML_SUFFIXES)
    text = F.try_validate_utf8(F.when(is_html, F.col("content").cast("string")))
    based = found.withColumn("_folder", F.concat("base_url", F.lit("/")))
    based = based.withColumn("_text", text)
    absolute = F.encode(rewrite_links("_text", "_folder"), "UTF-8")
    content = F.when(F.col("_text").isNotNull(), absolute).otherwise(F.col("content"))
    return based.withColumn("content", content).drop("_text", "_folder")


def keep(
    obtained: DataFrame,
    store: str,
    table: str,
    batch: str,
    hook: Callable[[dict], None] | None = None,
) -> None:
    """Store a batch of obtained files, then index them, then call the hook with each.

    In this order, an index entry always has its file. What was obtained is written once
    and read for all three; each step leaves the same when the batch runs again (the hook
    is called again).
    """
    spark: SparkSession = obtained.sparkSession
    path = scratch_dir(spark, "obtained")
    obtained.write.parquet(path)
    rows = spark.read.parquet(path)
    one_each = rows.dropDuplicates(["cik", "form_type", "accession_number", "save_name"])
    write_documents(stored_documents(one_each, "save_name", "content"), store, batch)
    append_index(index_rows(rows, "save_name").distinct(), table, batch)
    if hook is not None:
        for_each_filing(rows.drop("content"), hook)
