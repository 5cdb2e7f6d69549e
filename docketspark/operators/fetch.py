"""Fetch plans: which address each filing is taken from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.functions import urls
from docketspark.functions.columns import ColumnLike, as_column
from docketspark.functions.forms import preferred_type
from docketspark.functions.identifiers import file_name, file_suffix

_NO_URL_PARTS = 4096


def plan_urls(
    filings: DataFrame,
    form: ColumnLike = "form_type",
    preferred: ColumnLike | None = None,
    skip_not_preferred: bool = False,
) -> DataFrame:
    """Add ``preferred_type, file_url, fallback_url, skip``.

    ``form`` is the form that was asked for: an amendment is fetched in the
    default type of its base form.
    """
    # In steps, so that each value is computed once and then referred to.
    typed = filings.withColumn("preferred_type", preferred_type(form, preferred)).withColumn(
        "_suffix", file_suffix("main_file_name")
    )
    address = urls.file_url(
        "base_url",
        "accession_number",
        "main_file_name",
        "_suffix",
        "preferred_type",
        skip_not_preferred,
    )
    planned = typed.withColumn("file_url", address).drop("_suffix")
    return planned.withColumns(
        {
            "fallback_url": urls.join_url("base_url", "main_file_name"),
            "skip": F.col("file_url").isNull() & F.lit(skip_not_preferred),
        }
    )


def plan_by_accession(filings: DataFrame) -> DataFrame:
    """Plan for filings already identified: the main file, without a fallback."""
    base = urls.filing_base_url("cik", "accession_number")
    return filings.withColumn("base_url", base).withColumn(
        "file_url", urls.join_url("base_url", "main_file_name")
    )


def to_fetch(plan: DataFrame) -> DataFrame:
    """Planned rows that are not skipped."""
    return plan.where(~F.col("skip"))


def choose_available(
    plan: DataFrame, available: DataFrame, skip_not_preferred: bool = False
) -> DataFrame:
    """Take the preferred address if it exists, else the fallback; null if neither does.

    ``available`` holds a column ``url``. Both addresses of a filing lie in its folder, so
    the plan and the addresses are moved once, by folder, and a filing meets the addresses
    of its folder only. That partitioning also serves to merge repeated rows of the plan.
    A caller who skips other types gets no fallback.
    """
    columns = plan.columns

    def folder(url: Column) -> Column:
        return F.xxhash64(F.regexp_replace(url, "[^/]*$", ""))

    # Stands in for an address that need not be looked up; null keys would all
    # meet in one task.
    nowhere = F.pmod(F.xxhash64("accession_number"), F.lit(_NO_URL_PARTS))
    address = F.coalesce("file_url", "fallback_url")
    key = F.when(address.isNull(), nowhere).otherwise(folder(address))
    wanted = to_fetch(plan).withColumn("_folder", key)
    wanted = wanted.repartition("_folder").distinct()
    listed = available.where(F.col("url").isNotNull())
    exists = listed.groupBy(folder(F.col("url")).alias("_folder")).agg(
        F.collect_set("url").alias("_urls")
    )
    found = wanted.join(exists, "_folder", "left")

    def if_listed(address: Column) -> Column:
        return F.when(F.array_contains("_urls", address), address)

    first = if_listed(F.col("file_url"))
    spare = F.lit(None).cast("string") if skip_not_preferred else if_listed(F.col("fallback_url"))
    checked = found.withColumn("_first", first)
    checked = checked.withColumn("_spare", F.when(F.col("_first").isNull(), spare))
    return checked.select(
        *columns,
        F.coalesce("_first", "_spare").alias("fetched_url"),
        file_name(F.coalesce("_first", "_spare")).alias("save_name"),
        F.when(F.col("_first").isNotNull(), False)
        .when(F.col("_spare").isNotNull(), True)
        .alias("used_fallback"),
    )


def fetch_summary(fetched: DataFrame) -> DataFrame:
    """Files obtained and missed per company and form."""
    obtained: Column = as_column("fetched_url").isNotNull()
    return fetched.groupBy("cik", "form_type").agg(
        F.count_if(obtained).alias("n_files"),
        F.count_if(~obtained).alias("n_missing"),
    )
