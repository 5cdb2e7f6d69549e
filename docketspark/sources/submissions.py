"""Per-company submission documents -> filing catalog."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.functions.identifiers import accession, cik10, file_name
from docketspark.schemas import RECENT_FIELDS, SUBMISSION

_KEY_IN_NAME = r"CIK([0-9]{10})"


def read_submissions(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    """All submission documents below ``path`` as ``cik, filings, name``.

    The company key comes from the document, else from the file name. For one
    company give the path of its file: nothing else is listed or read.
    """
    docs = spark.read.schema(SUBMISSION).option("multiLine", multi_line).json(path)
    return with_company_key(docs, F.col("_metadata.file_name"))


def with_company_key(docs: DataFrame, name: Column, keep: Sequence[str] = ()) -> DataFrame:
    """``cik, filings, name`` with the key normalised, taken from ``name`` where absent."""
    key = F.coalesce(
        cik10("cik"), F.nullif(F.regexp_extract(name, _KEY_IN_NAME, 1), F.lit(""))
    )
    return docs.select(key.alias("cik"), "filings", name.alias("name"), *keep)


def parse_submissions(
    docs: DataFrame, text: str = "v", name: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Submission documents held as JSON text; only the needed fields are decoded."""
    doc = F.from_json(F.col(text), SUBMISSION)
    source = F.col(name) if name else F.lit(None).cast("string")
    parsed = docs.select(doc.alias("d"), source.alias("_name"), *keep)
    return with_company_key(parsed.select("d.*", "_name", *keep), F.col("_name"), keep)


def _well_formed() -> Column:
    """All parallel arrays are present and equally long."""
    arrays = [F.col(f"filings.recent.{name}") for name in RECENT_FIELDS]
    same_length = reduce(
        lambda a, b: a & b, [F.size(arrays[0]) == F.size(other) for other in arrays[1:]]
    )
    # ``size`` is null for a null array; a missing array makes the test null.
    return F.coalesce(same_length, F.lit(False)) & F.col("cik").isNotNull()


def malformed_submissions(docs: DataFrame, *keep: str) -> DataFrame:
    """Documents the catalog cannot hold: no key, an array missing, or unequal lengths;
    text that is no document has neither. ``keep`` names further columns, such as ``name``."""
    sizes = [F.size(f"filings.recent.{name}").alias(name) for name in RECENT_FIELDS]
    return docs.where(~_well_formed()).select("cik", *keep, *sizes)


def explode_submissions(docs: DataFrame) -> DataFrame:
    """One row per filing: the parallel arrays are read side by side."""
    arrays = F.arrays_zip(*[F.col(f"filings.recent.{name}").alias(name) for name in RECENT_FIELDS])
    # The test sits inside the generator: as a filter it would be pushed below the
    # parsing of JSON text and parse every document twice.
    listed = F.posexplode_outer(F.when(_well_formed(), arrays)).alias("pos", "filing")
    rows = docs.select("cik", listed).where(F.col("pos").isNotNull())
    return rows.select(
        "cik",
        "pos",
        F.col("filing.form").alias("form_type"),
        accession("filing.accessionNumber").alias("accession_number"),
        file_name("filing.primaryDocument").alias("main_file_name"),
        F.col("filing.filingDate").try_cast("date").alias("filing_date"),
        F.array(F.col("filing.fileNumber")).alias("file_num"),
    )


def write_catalog(filings: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store a catalog so that company and date filters skip row groups.

    Ranges cover the date and accession too, so one very large company spans
    several files instead of one task.
    """
    order = ["cik", "filing_date", "accession_number"]
    filings.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)
