"""Snapshots of the stored files, and what changed between two of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.sources.files import MANIFEST_SCHEMA


def write_snapshot(manifest: DataFrame, table: str, snapshot: str) -> None:
    """Keep a listing (``file_path, length, modified``) under a name; the same name again
    replaces it. A path that is listed twice is kept as it was modified last."""
    last = F.max(F.struct("modified", "length")).alias("last")
    rows = manifest.where(F.col("file_path").isNotNull()).groupBy("file_path").agg(last)
    (
        rows.select("file_path", "last.length", "last.modified")
        .repartitionByRange("file_path")
        .sortWithinPartitions("file_path")
        .write.mode("overwrite")
        .parquet(f"{table.rstrip('/')}/snapshot={snapshot}")
    )


def read_snapshot(spark: SparkSession, table: str, snapshot: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{table.rstrip('/')}/snapshot={snapshot}")


def snapshot_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """``file_path, change, old_length, new_length, old_modified, new_modified`` of the files
    that were ``added``, ``removed`` or ``changed`` (length or time of change).

    One full outer join on the path; each snapshot has a path once. What stayed the same
    is not given, so everything that follows grows with the change and not with the store.
    """
    sides = []
    for name, side in (("old", old), ("new", new)):
        columns = [F.col(c).alias(f"{name}_{c}") for c in ("length", "modified")]
        sides.append(side.select("file_path", *columns, F.lit(True).alias(f"in_{name}")))
    both = sides[0].join(sides[1], "file_path", "full")
    differs = ~F.col("old_length").eqNullSafe(F.col("new_length")) | ~F.col("old_modified").eqNullSafe(
        F.col("new_modified")
    )
    change = (
        F.when(F.col("in_old").isNull(), "added")
        .when(F.col("in_new").isNull(), "removed")
        .when(differs, "changed")
    )
    found = both.withColumn("change", change).where(F.col("change").isNotNull())
    return found.select(
        "file_path", "change", "old_length", "new_length", "old_modified", "new_modified"
    )
