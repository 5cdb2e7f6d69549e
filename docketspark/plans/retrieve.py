"""Requested filings of many companies in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions.columns import ColumnLike
from docketspark.functions.forms import base_form, is_amendment
from docketspark.functions.skew import join_hot
from docketspark.operators.entities import resolve_companies, unresolved
from docketspark.operators.fetch import choose_available, plan_urls
from docketspark.operators.index import index_rows
from docketspark.operators.selection import matches_text, newest_per_group
from docketspark.sources.search import hit_metadata

_KEY = ["request_cik", "request_form"]
_REQUEST = [*_KEY, "request_after", "request_before"]


def requested_filings(
    requests: DataFrame,
    tickers: DataFrame,
    hits: DataFrame,
    number_of_filings: int = 100,
    amendments: bool = True,
    query: str | None = None,
) -> DataFrame:
    """Metadata of the filings each request asks for.

    ``requests``: ``ticker_or_cik, form_type, after_date, before_date`` (dates may
    be null: open). Equal requests are one request; requests that differ in a
    date each get their own newest filings. A hit belongs to every company it names. With
    a ``query``, hits have a column ``text``, and those count whose text it matches.
    """
    if query is not None:
        hits = hits.where(matches_text("text", query))
    resolved = resolve_companies(requests.distinct(), tickers).where(F.col("cik").isNotNull())
    wanted = resolved.select(
        F.col("cik").alias("request_cik"),
        F.col("form_type").alias("request_form"),
        F.col("after_date").alias("request_after"),
        F.col("before_date").alias("request_before"),
    ).distinct()
    if not amendments:
        hits = hits.where(~is_amendment("file_type"))
    # An amendment answers requests for its base form and for itself.
    names = F.array_distinct(F.array("file_type", base_form("file_type")))
    by_company = hits.withColumn("request_form", F.explode(names)).withColumn(
        "request_cik", F.explode(F.array_distinct("ciks"))
    )
    # Open bounds hold for any date, so a hit without a date answers open requests only.
    after, before, date = F.col("request_after"), F.col("request_before"), F.col("filing_date")
    asked = join_hot(by_company, wanted, _KEY, ["hit_id"]).where(
        (after.isNull() | (date >= after)) & (before.isNull() | (date <= before))
    )
    return newest_per_group(hit_metadata(asked), _REQUEST, number_of_filings).drop("rank")


def retrieve(
    requests: DataFrame,
    tickers: DataFrame,
    hits: DataFrame,
    available: DataFrame,
    number_of_filings: int = 100,
    amendments: bool = True,
    skip_not_preferred: bool = False,
    preferred: ColumnLike | None = None,
    query: str | None = None,
) -> DataFrame:
    """The requested filings with the address each is taken from.

    ``preferred`` is the file type asked for (text, or a column of the hits); without it
    each form has its own.
    """
    if isinstance(preferred, str):
        preferred = F.lit(preferred)
    filings = requested_filings(requests, tickers, hits, number_of_filings, amendments, query)
    plan = plan_urls(filings, "request_form", preferred, skip_not_preferred)
    return choose_available(plan, available, skip_not_preferred)


def request_rejects(requests: DataFrame, tickers: DataFrame) -> DataFrame:
    """Requests that name no known company, each once."""
    return unresolved(resolve_companies(requests.distinct(), tickers))


def retrieved_index(fetched: DataFrame) -> DataFrame:
    """Index rows of the filings that were obtained."""
    obtained = fetched.where(F.col("fetched_url").isNotNull())
    return index_rows(obtained, "save_name").distinct()
