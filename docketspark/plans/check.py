"""Check of the stored index against the stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.operators.index import kept_of, mark_entries, with_stored
from docketspark.schemas import INDEX_COLUMNS
from docketspark.session import scratch_dir
from docketspark.sinks.index_table import (
    entries_of_files,
    read_index,
    replace_folders,
    rewrite_index,
    stored_entries,
)


def check_index(
    spark: SparkSession, table: str, manifest: DataFrame, new_table: str
) -> tuple[str, int]:
    """Remove repeated rows and rows without a file.

    Returns where the index now is and how many rows were removed. Nothing is
    written when there is nothing to remove. The index meets the files once: what is found
    is stored, and both the count and the rows to keep come from there.
    """
    found = scratch_dir(spark, "marked")
    mark_entries(read_index(spark, table), manifest).write.parquet(found)
    marked = spark.read.parquet(found)
    # Every copy of a missing entry goes, and all but one of any other.
    gone = F.when(F.col("stored"), F.col("copies") - 1).otherwise(F.col("copies"))
    count = marked.agg(F.sum(gone).alias("n")).first()["n"] or 0
    if count == 0:
        return table, 0
    rewrite_index(kept_of(marked), new_table)
    return new_table, count


def _replace(spark: SparkSession, table: str, marked: DataFrame, folders: DataFrame) -> None:
    """Write the folders anew from ``marked`` (entries with ``keeper``, the batch that keeps
    them, ``filed_in`` and ``stored``)."""
    kept = marked.where("stored").withColumnRenamed("keeper", "batch")
    kept = kept.join(F.broadcast(folders), ["batch", "filed_in"])
    replace_folders(kept, folders, table)


def check_in_place(spark: SparkSession, table: str, manifest: DataFrame) -> tuple[int, int]:
    """Remove repeated rows and rows without a file, touching only the folders they are in.

    Returns how many rows were removed and how many folders written. An entry that is
    repeated stays in the least of its batches. Folders are the table's partitions by batch
    and year, so one missing file costs one of them, however large the index is.
    """
    rows = stored_entries(spark, table)
    entries = rows.groupBy(*INDEX_COLUMNS, "filed_in").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("batch").alias("keeper"),
        F.collect_set("batch").alias("batches"),
    )
    found = scratch_dir(spark, "marked")
    with_stored(entries, manifest).write.parquet(found)
    marked = spark.read.parquet(found)
    gone = F.when(F.col("stored"), F.col("copies") - 1).otherwise(F.col("copies"))
    touched = marked.withColumn("gone", gone).where("gone > 0")
    count = touched.agg(F.sum("gone").alias("n")).first()["n"] or 0
    if count == 0:
        return 0, 0
    folders = touched.select(F.explode("batches").alias("batch"), "filed_in").distinct()
    _replace(spark, table, marked, folders)
    return count, folders.count()


def check_changes(
    spark: SparkSession,
    table: str,
    difference: DataFrame,
    manifest: DataFrame,
    checked: list[str],
) -> tuple[int, int]:
    """The same as ``check_in_place``, for a table whose batches ``checked`` agreed with the
    last snapshot: those are only held against the files that were removed since
    (``difference``), and later batches against the whole ``manifest``.

    Of the checked batches only the years of removed files are read, and only folders that lose a
    row are written.
    """
    removed = difference.where("change = 'removed'").select("file_path")
    gone = entries_of_files(spark, table, removed).where(F.col("batch").isin(checked))
    later = stored_entries(spark, table).where(~F.col("batch").isin(checked))
    fresh = with_stored(later.groupBy(*later.columns).agg(F.count(F.lit(1)).alias("copies")), manifest)
    lost = scratch_dir(spark, "lost")
    (
        gone.groupBy(*gone.columns).agg(F.count(F.lit(1)).alias("copies"))
        .unionByName(fresh.where(~F.col("stored")).drop("stored"))
        .write.parquet(lost)
    )
    lost_rows = spark.read.parquet(lost)
    count = lost_rows.agg(F.sum("copies").alias("n")).first()["n"] or 0
    if count == 0:
        return 0, 0
    folders = lost_rows.select("batch", "filed_in").distinct()
    there = stored_entries(spark, table).join(F.broadcast(folders), ["batch", "filed_in"])
    same = [there[c].eqNullSafe(lost_rows[c]) for c in (*INDEX_COLUMNS, "batch", "filed_in")]
    staged = scratch_dir(spark, "kept")
    there.join(lost_rows, same, "left_anti").write.parquet(staged)
    return count, replace_folders(spark.read.parquet(staged), folders, table)
