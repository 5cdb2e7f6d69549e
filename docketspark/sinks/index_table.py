"""The stored filing index: Parquet, one folder per appended batch.

A batch is written to a folder of its own name, so a batch that is run again
replaces what its first run left behind. Below that, rows are laid out by the
year digits of their accession number, and sorted by company. Both are part of the
entry's key, so an append need only compare with the years its batch holds, and within
their files with the row groups its companies fall in. Batches are merged from time to
time by ``compact_index``.

There is one writer at a time; plain Parquet has no transactions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketspark.functions.identifiers import accession_from_path
from docketspark.operators.index import file_number_lists, not_indexed, one_per_key
from docketspark.schemas import INDEX, INDEX_COLUMNS

# Companies of a batch that are looked for one by one.
COMPANY_LIST = 1_000

_LAYOUT = [T.StructField(name, T.StringType()) for name in ("batch", "filed_in")]
_STORED = T.StructType([*INDEX.fields, *_LAYOUT])


def _filed_in() -> Column:
    """Two year digits of the accession number, or ``xx``: at most 101 values."""
    digits = F.substring(accession_from_path("file_path"), 11, 2)
    return F.when(digits.rlike("^[0-9]{2}$"), digits).otherwise(F.lit("xx"))


def _stored(spark: SparkSession, table: str) -> DataFrame | None:
    try:
        return spark.read.schema(_STORED).parquet(table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_index(spark: SparkSession, table: str) -> DataFrame:
    stored = _stored(spark, table)
    if stored is None:
        return spark.createDataFrame([], INDEX)
    return stored.select(*INDEX_COLUMNS)


def append_index(rows: DataFrame, table: str, batch: str) -> None:
    """Append the rows whose entries are new; one code path for one filing or many."""
    spark = rows.sparkSession
    fresh = one_per_key(rows).withColumn("filed_in", _filed_in()).persist()
    try:
        stored = _stored(spark, table)
        new = fresh
        if stored is not None:
            others = stored.where((F.col("batch") != batch) & _may_match(fresh))
            new = not_indexed(fresh, others)
        (
            new.hint("rebalance", "filed_in")
            .sortWithinPartitions("filed_in", "cik")
            .write.mode("overwrite")
            .partitionBy("filed_in")
            .parquet(f"{table.rstrip('/')}/batch={batch}")
        )
    finally:
        fresh.unpersist()


def _may_match(batch: DataFrame) -> Column:
    """Where entries equal to those of a batch may be: its years, and its companies.

    Years are folders. Companies are a list while they are few, else the range they span;
    either reaches the statistics of the files, which are sorted by company.
    """
    # At most 101 short strings, whatever the size of the batch.
    years = [row[0] for row in batch.select("filed_in").distinct().collect()]
    in_years = F.col("filed_in").isin(years)
    companies = batch.select("cik").distinct().limit(COMPANY_LIST + 1).collect()
    if any(row[0] is None for row in companies):
        return in_years
    if len(companies) <= COMPANY_LIST:
        return in_years & F.col("cik").isin([row[0] for row in companies])
    span = batch.agg(F.min("cik"), F.max("cik"), F.bool_or(F.col("cik").isNull())).first()
    return in_years if span[2] else in_years & F.col("cik").between(span[0], span[1])


def compact_index(spark: SparkSession, table: str, new_table: str) -> None:
    """Merge the batches of a table into a new one, which readers and the writer go on with.

    A stream's batch that runs again afterwards finds its entries in the merged batch and
    adds an empty folder, so it still leaves each entry once.
    """
    rewrite_index(one_per_key(read_index(spark, table)), new_table)


def rewrite_index(kept: DataFrame, table: str) -> None:
    """Write a checked index as a new table of one batch.

    The new location must not exist: a table is never overwritten while it is
    being read. Readers switch to it afterwards. Also serves to merge the many
    small batches of a stream.
    """
    (
        kept.withColumn("filed_in", _filed_in())
        .withColumn("batch", F.lit("checked"))
        .repartitionByRange("filed_in", "cik", "file_path")
        .sortWithinPartitions("filed_in", "cik", "filing_date")
        .write.mode("errorifexists")
        .partitionBy("batch", "filed_in")
        .parquet(table)
    )


def stored_entries(spark: SparkSession, table: str) -> DataFrame:
    """Index rows with the folder they are in: ``batch, filed_in``."""
    stored = _stored(spark, table)
    return stored if stored is not None else spark.createDataFrame([], _STORED)


def replace_folders(kept: DataFrame, folders: DataFrame, table: str) -> int:
    """Give some folders (``batch, filed_in``) of a table the rows ``kept``, which name their
    folder too; no file of any other folder is touched. Returns the number of folders.

    ``kept`` must come from elsewhere, such as a scratch table: a folder is not read while
    it is replaced. Spark replaces the folders that get rows; those that lose all are left
    with an empty file. Running it again after a failure gives the same table, as long as
    ``kept`` is still there. Readers of the table wait until it is done.
    """
    columns = [*INDEX_COLUMNS, "batch", "filed_in"]
    # As many rows as the table has folders, which the driver lists on every read.
    wanted = {tuple(row) for row in folders.select("batch", "filed_in").distinct().collect()}
    filled = {tuple(row) for row in kept.select("batch", "filed_in").distinct().collect()}
    if not filled <= wanted:
        raise ValueError(f"rows for folders that are not replaced: {sorted(filled - wanted)[:3]}")
    (
        kept.select(*columns)
        .hint("rebalance", "batch", "filed_in")
        .sortWithinPartitions("batch", "filed_in", "cik", "filing_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch", "filed_in")
        .parquet(table)
    )
    empty = kept.sparkSession.createDataFrame([], INDEX).coalesce(1)
    for batch, filed_in in sorted(wanted - filled):
        folder = f"{table.rstrip('/')}/batch={batch}/filed_in={filed_in}"
        empty.write.mode("overwrite").parquet(folder)
    return len(wanted)


def entries_of_files(spark: SparkSession, table: str, paths: DataFrame) -> DataFrame:
    """Stored rows (with their folder) of the given files (``file_path``).

    Only the years that the paths name are read: a folder's year comes from the path.
    """
    entries = stored_entries(spark, table)
    wanted = paths.where(F.col("file_path").isNotNull()).select("file_path").distinct()
    years = [row[0] for row in wanted.select(_filed_in()).distinct().collect()]  # at most 101
    there = entries.where(F.col("filed_in").isin(years))
    return there.join(wanted, "file_path", "left_semi").select(*entries.columns)


def write_file_number_index(index: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Export JSON lines ``{file number: [[form, path, date], …]}``, as imports read them.

    A line holds a number's entries of one company and month; a number's lines in order of
    month are its whole list.
    """
    entry = F.transform(
        "entries",
        lambda e: F.array(e["form_type"], e["file_path"], e["filing_date"].cast("string")),
    )
    lists = file_number_lists(index)
    ordered = lists.repartitionByRange("cik", "file_number", "month")
    ordered = ordered.sortWithinPartitions("cik", "file_number", "month")
    lines = ordered.select(F.to_json(F.create_map("file_number", entry)).alias("value"))
    lines.write.mode(mode).text(path)
