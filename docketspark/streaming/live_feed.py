"""Live feed of new filings without repeats."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docketspark.streaming.index_stream import batch_name


def without_repeats(filings: DataFrame, delay: str = "30 days") -> DataFrame:
    """Each accession number once, with state bounded by ``delay``.

    For a live tail, where filings arrive about in date order: rows older than
    the watermark are dropped and counted in the query's progress. Where that can happen
    and matters, use ``write_keyed_feed``, which drops nothing.
    """
    timed = filings.withColumn("filing_ts", F.col("filing_date").cast("timestamp"))
    return timed.withWatermark("filing_ts", delay).dropDuplicatesWithinWatermark(
        ["accession_number"]
    )


def append_feed(batch: DataFrame, path: str, name: str) -> None:
    """Add the filings of a batch whose accession number the feed does not hold yet.

    Rows are laid out by the year digits of the accession number, so a batch is compared
    with its own years only. Of rows with one number the newest is taken. A batch that runs
    again replaces its own folder.
    """
    spark = batch.sparkSession
    digits = F.substring("accession_number", 11, 2)
    year = F.when(digits.rlike("^[0-9]{2}$"), digits).otherwise(F.lit("xx"))
    columns = [c for c in batch.columns if c != "accession_number"]
    latest = F.max(F.struct("filing_date", *[c for c in columns if c != "filing_date"]))
    once = batch.groupBy("accession_number").agg(latest.alias("f"))
    fresh = once.select("accession_number", *[f"f.{c}" for c in columns])
    fresh = fresh.withColumn("filed_in", year).persist()
    try:
        stored = read_feed(spark, path, fresh.schema)
        if stored is not None:
            years = [row[0] for row in fresh.select("filed_in").distinct().collect()]  # 101 at most
            others = stored.where((F.col("batch") != name) & F.col("filed_in").isin(years))
            keys = others.select("accession_number")
            known = fresh["accession_number"].eqNullSafe(keys["accession_number"])
            new = fresh.join(keys, known, "left_anti")
        else:
            new = fresh
        rows = new.hint("rebalance", "filed_in").write.mode("overwrite").partitionBy("filed_in")
        rows.parquet(f"{path.rstrip('/')}/batch={name}")
    finally:
        fresh.unpersist()


def read_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The feed with its ``batch`` and ``filed_in``; nothing if it has not been written."""
    names = [field for field in schema.fields if field.name not in ("batch", "filed_in")]
    layout = [T.StructField(name, T.StringType()) for name in ("batch", "filed_in")]
    try:
        return spark.read.schema(T.StructType([*names, *layout])).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_keyed_feed(filings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each accession number once, in whatever order filings arrive, and none dropped.

    The feed itself says what has been seen, so there is no state that has to be bounded
    by a delay. For feeds of any age; ``without_repeats`` is for a live tail.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        append_feed(batch, path, batch_name(batch, batch_id))

    return (
        filings.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_feed(feed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        feed.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows the watermark dropped, over the progress the query still holds."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
