"""Documents: links and stored content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions import html as H
from docketspark.functions.forms import HTML_SUFFIXES
from docketspark.functions.identifiers import file_suffix, relative_path
from docketspark.functions.urls import resolve_url


def extract_links(pages: DataFrame, keys: list[str], html: str, base: str) -> DataFrame:
    """One row per link: ``keys, link_no, tag, address, url``."""
    tags = F.filter(H.html_tokens(html), H.is_link_tag)
    rows = pages.select(
        *keys, F.col(base).alias("_base"), F.posexplode(tags).alias("link_no", "_tag")
    )
    return rows.select(
        *keys,
        "link_no",
        H.link_tag_name("_tag").alias("tag"),
        H.link_address("_tag").alias("address"),
        resolve_url("_base", H.link_address("_tag")).alias("url"),
    )


def rewrite_documents(
    documents: DataFrame, html: str, base: str, name: str | None = None
) -> DataFrame:
    """Make the links in column ``html`` absolute; files of other suffixes stay as they are.

    ``base`` is the address of the document itself; for a folder end it with ``/``.
    """
    rewritten = H.rewrite_links(html, base)
    if name is not None:
        is_html = file_suffix(name).isin(HTML_SUFFIXES)
        rewritten = F.when(is_html, rewritten).otherwise(F.col(html))
    return documents.withColumn(html, rewritten)


def stored_documents(documents: DataFrame, name: str, content: str) -> DataFrame:
    """Rows of the document store, keyed by the path a file would have on disk.

    ``member`` and ``part`` are null for main files; archive members have both.
    """
    path = relative_path("cik", "form_type", "accession_number", name)
    data = F.col(content).cast("binary")
    return documents.select(
        path.alias("file_path"),
        "cik",
        "form_type",
        "accession_number",
        F.lit(None).cast("string").alias("member"),
        F.lit(None).cast("int").alias("part"),
        data.alias("content"),
        F.length(data).cast("bigint").alias("content_length"),
    )


def stored_members(contents: DataFrame) -> DataFrame:
    """Archive members as further rows of the store, next to their archive.

    ``contents`` are the members of stored archives, named by their path in the
    store. That path holds the company, form and accession number, so contents
    are not moved for a join.
    """
    folder = F.regexp_replace("archive", "[^/]*$", "")
    segments = F.split("archive", "/")
    return contents.select(
        F.concat(folder, F.col("member")).alias("file_path"),
        F.get(segments, 0).alias("cik"),
        F.get(segments, 1).alias("form_type"),
        F.get(segments, 2).alias("accession_number"),
        "member",
        "part",
        "content",
        F.length("content").cast("bigint").alias("content_length"),
    )
