"""Import of index files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.functions.columns import blank_to_null, explode_parsed
from docketspark.functions.identifiers import absolute_path, accession_from_path
from docketspark.schemas import FILE_NUMBER_MAP, INDEX_COLUMNS, INDEX_CSV


def _as_index(entries: DataFrame) -> DataFrame:
    """Entries with forward slashes, a date, and the company key their path starts with.

    A blank file number is none, as in ``index_rows``.
    """
    path = F.translate("file_path", "\\", "/")
    return entries.select(
        F.substring_index(path, "/", 1).alias("cik"),
        "form_type",
        blank_to_null("file_number").alias("file_number"),
        path.alias("file_path"),
        F.col("filing_date").try_cast("date").alias("filing_date"),
    ).select(*INDEX_COLUMNS)


def read_index_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Base-index files with a header, one or many per company."""
    return _as_index(spark.read.schema(INDEX_CSV).option("header", True).csv(path))


def parse_file_number_index(docs: DataFrame, text: str = "v") -> DataFrame:
    """Index rows from ``{file number: [[form type, path, date], …]}``."""
    parsed = F.from_json(F.col(text), FILE_NUMBER_MAP)
    numbers = explode_parsed(docs, parsed, ["file_number", "entries"])
    rows = numbers.select("file_number", F.explode("entries").alias("entry"))
    return _as_index(
        rows.select(
            F.get("entry", 0).alias("form_type"),
            "file_number",
            F.get("entry", 1).alias("file_path"),
            F.get("entry", 2).alias("filing_date"),
        )
    )


def with_locations(index: DataFrame, root: str) -> DataFrame:
    """Index rows with absolute paths and the accession number in the path."""
    return index.withColumn("accession_number", accession_from_path("file_path")).withColumn(
        "file_path", absolute_path(root, "file_path")
    )
