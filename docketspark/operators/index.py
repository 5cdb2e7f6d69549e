"""The filing index: one row per stored file and file number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions.columns import blank_to_null
from docketspark.functions.identifiers import cik10, relative_path, safe_form
from docketspark.functions.skew import group_sizes, join_hot, same
from docketspark.schemas import INDEX_COLUMNS, INDEX_KEY


def index_rows(filings: DataFrame, name: str = "main_file_name") -> DataFrame:
    """Index rows of filings; a filing with several file numbers gets several rows.

    A blank file number is none; a filing without any has one row with null.
    """
    numbers = F.array_distinct(F.transform("file_num", blank_to_null))
    numbers = F.when(F.array_size(numbers) > 1, F.array_compact(numbers)).otherwise(numbers)
    rows = filings.select("*", F.explode_outer(numbers).alias("file_number"))
    return rows.select(
        "cik",
        safe_form("form_type").alias("form_type"),
        "file_number",
        relative_path("cik", "form_type", "accession_number", name).alias("file_path"),
        "filing_date",
    )


def one_per_key(index: DataFrame) -> DataFrame:
    """One row per entry; the earliest date is kept where copies disagree."""
    rows = index.groupBy(*INDEX_KEY).agg(F.min("filing_date").alias("filing_date"))
    return rows.select(*INDEX_COLUMNS)


def not_indexed(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose entry the index does not hold yet."""
    known = index.select(*INDEX_KEY)
    return rows.join(known, same(rows, known, INDEX_KEY), "left_anti")


def of_form(index: DataFrame, form_type: str) -> DataFrame:
    """Entries of a form, given in its usual (``S-1/A``) or stored (``S-1.A``) spelling."""
    return index.where(F.col("form_type") == safe_form(F.lit(form_type)))


def of_company(index: DataFrame, cik: str) -> DataFrame:
    return index.where(F.col("cik") == cik10(F.lit(cik)))


def of_file_number(index: DataFrame, cik: str, file_number: str) -> DataFrame:
    """Entries sharing a file number; empty for an unknown one."""
    return of_company(index, cik).where(F.col("file_number") == file_number)


def related_filings(index: DataFrame, requested: DataFrame) -> DataFrame:
    """Entries of the requested ``cik, file_number`` pairs, each entry once."""
    keys = ["cik", "file_number"]
    wanted = requested.select(*keys).distinct()
    return join_hot(index, wanted, keys, ["file_path"], "left_semi").select(*INDEX_COLUMNS)


def related_summary(index: DataFrame) -> DataFrame:
    """Each entry with how many others share its file number, and their date span.

    Answers "what is related to this filing" for all filings at once in output
    linear in the index; ``related_filings`` gives the entries of those of interest.
    """
    keys = ["cik", "file_number"]
    entries = index.where(F.col("file_number").isNotNull()).distinct()
    groups = _number_groups(entries)
    found = groups.select(
        *keys, (F.col("n_entries") - 1).alias("n_related"), "first_date", "last_date"
    )
    joined = join_hot(entries, found, keys, ["file_path"], sizes=group_sizes(index, keys))
    return joined.select(*INDEX_COLUMNS, "n_related", "first_date", "last_date")


def _number_groups(entries: DataFrame) -> DataFrame:
    return entries.groupBy("cik", "file_number").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.min("filing_date").alias("first_date"),
        F.max("filing_date").alias("last_date"),
    )


def file_number_groups(index: DataFrame) -> DataFrame:
    """Entries, forms and date span of each file number."""
    numbered = index.where(F.col("file_number").isNotNull()).distinct()
    return numbered.groupBy("cik", "file_number").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.count_distinct("form_type").alias("n_forms"),
        F.min("filing_date").alias("first_date"),
        F.max("filing_date").alias("last_date"),
    )


def file_number_lists(index: DataFrame) -> DataFrame:
    """Export form ``cik, file_number, month, entries``: sorted lists of entries.

    A list holds a file number's entries of one month of filing, whatever their number
    elsewhere, so the lists are the same at any size and in order of month the whole.
    """
    entries = index.where(F.col("file_number").isNotNull()).distinct()
    month = F.date_format("filing_date", "yyyy-MM").alias("month")
    entry = F.struct("filing_date", "file_path", "form_type")
    return entries.groupBy("cik", "file_number", month).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )


# Parts that entries without a file path are spread over.
_NO_PATH_PARTS = 4096


def _marked(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct entries with ``copies`` and whether their file is ``stored``.

    An outer join, because the optimizer moves semi and anti joins below the
    aggregation, where an entry repeated many times is compared many times. Entries
    without a path have keys that match no file and do not meet in one task.
    """
    return with_stored(index.groupBy(*INDEX_COLUMNS).agg(F.count(F.lit(1)).alias("copies")), manifest)


def with_stored(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """Entries with whether their file is ``stored``."""
    spread = F.pmod(F.xxhash64(*INDEX_COLUMNS), F.lit(_NO_PATH_PARTS)).cast("string")
    key = F.coalesce("file_path", F.concat(F.lit("\t"), spread))
    files = manifest.where(F.col("file_path").isNotNull()).select(F.col("file_path").alias("_key"))
    files = files.distinct().withColumn("_stored", F.lit(True))
    marked = entries.withColumn("_key", key).join(files, "_key", "left").drop("_key")
    return marked.withColumn("stored", F.coalesce("_stored", F.lit(False))).drop("_stored")


def index_kept(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """The index after a check: no repeated rows, no rows without a stored file."""
    return kept_of(_marked(index, manifest))


def kept_of(marked: DataFrame) -> DataFrame:
    return marked.where("stored").select(*INDEX_COLUMNS)


def mark_entries(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct entries with ``copies`` and ``stored``, to be stored and used several times."""
    return _marked(index, manifest)


def index_removed(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """Entries whose file is not stored."""
    return _marked(index, manifest).where(~F.col("stored")).select(*INDEX_COLUMNS)


def check_report(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per company: rows read, removed as repeats, removed as missing, and kept.

    ``file_numbers_dropped`` counts file numbers no kept entry refers to.
    """
    return report_of(_marked(index, manifest))


def report_of(marked: DataFrame) -> DataFrame:
    """``check_report`` of entries that are already marked."""
    numbers = (
        marked.groupBy("cik", "file_number")
        .agg(
            F.sum("copies").alias("entries"),
            F.sum(F.col("copies") - 1).alias("duplicates_removed"),
            F.count_if(~F.col("stored")).alias("missing_removed"),
            F.count_if("stored").alias("entries_kept"),
        )
    )
    totals = ["entries", "duplicates_removed", "missing_removed", "entries_kept"]
    return numbers.groupBy("cik").agg(
        *[F.sum(name).alias(name) for name in totals],
        F.count_if(F.col("entries_kept") == 0).alias("file_numbers_dropped"),
    )
