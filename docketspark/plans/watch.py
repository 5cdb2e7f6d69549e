"""New filings of all companies since a date, compared with the index."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions.identifiers import accession_from_path, file_name
from docketspark.functions.urls import filing_base_url, join_url
from docketspark.operators.index import index_rows, not_indexed
from docketspark.operators.selection import newer_filings
from docketspark.sources.archives import (
    archive_members,
    member_rejects,
    member_text,
    whole_contents,
)
from docketspark.sources.submissions import (
    explode_submissions,
    malformed_submissions,
    parse_submissions,
)


def new_filings(
    filings: DataFrame, index: DataFrame, after: str, tracked: Iterable[str] | None = None
) -> DataFrame:
    """Index rows of newer filings that are not indexed yet, with the address to fetch."""
    rows = not_indexed(index_rows(newer_filings(filings, after, tracked)), index)
    base = filing_base_url("cik", accession_from_path("file_path"))
    return rows.withColumn("file_url", join_url(base, file_name("file_path")))


def _documents(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    members = archive_members(archives).where(F.col("member").endswith(".json"))
    return members, whole_contents(members, rejects=True)


def archive_catalog(archives: DataFrame) -> DataFrame:
    """Catalog of the submission documents inside archives (column ``archive``).

    ``archive_rejects`` lists what it cannot hold.
    """
    _, contents = _documents(archives)
    return explode_submissions(parse_submissions(member_text(contents), name="member"))


def archive_rejects(archives: DataFrame) -> DataFrame:
    """``archive, member, reason`` of members without rows in the catalog: too long for
    any value, unreadable, or no well-formed submission document."""
    members, contents = _documents(archives)
    parsed = parse_submissions(member_text(contents), name="member", keep=["archive"])
    malformed = malformed_submissions(parsed, "archive", "name")
    reason = F.lit("no well-formed submission document").alias("reason")
    named = malformed.select("archive", F.col("name").alias("member"), reason)
    return member_rejects(members, contents).unionByName(named)
