"""Index kept up to date from arriving submission documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketspark.operators.index import index_rows
from docketspark.schemas import SUBMISSION
from docketspark.sinks.index_table import append_index
from docketspark.sources.submissions import (
    explode_submissions,
    malformed_submissions,
    parse_submissions,
    with_company_key,
)


def stream_submissions(
    spark: SparkSession, path: str, multi_line: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """Arriving submission documents as a stream of filings."""
    reader = spark.readStream.schema(SUBMISSION).option("multiLine", multi_line)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    docs = with_company_key(reader.json(path), F.col("_metadata.file_name"))
    return explode_submissions(docs)


def stream_documents(
    spark: SparkSession, path: str, whole_files: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """Arriving submission documents as text ``v`` with the ``name`` of their file, so that
    those which are no documents can be reported."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    texts = reader.text(path, wholetext=whole_files)
    return texts.select(F.col("value").alias("v"), F.col("_metadata.file_name").alias("name"))


def documents_to_index(
    documents: DataFrame, table: str, rejects: str, checkpoint: str
) -> StreamingQuery:
    """``stream_to_index`` from document text, with malformed documents beside the table.

    Each batch leaves a folder below ``rejects`` with ``cik, name`` and array lengths of the
    documents that gave no rows; a batch that runs again replaces its own folder.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, batch_id)
        parsed = parse_submissions(batch, name="name")
        malformed = malformed_submissions(parsed, "name")
        malformed.write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/batch={name}")
        append_index(index_rows(explode_submissions(parsed)), table, name)

    return (
        documents.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_name(batch: DataFrame, batch_id: int) -> str:
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise ValueError("the stream has no query id to name its batches by")
    return f"{query}-{batch_id:012d}"


def stream_to_index(filings: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append new entries to the index table until the input is used up.

    A delivered document repeats all filings of its company, so every batch is
    compared with the table. A batch that is run again after a failure replaces
    its own folder and so leaves each entry once. Batches are named after the
    query too, whose id lives in the checkpoint: a stream started anew counts
    from zero but must not replace the batches of the one before it.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        append_index(batch, table, batch_name(batch, batch_id))

    return (
        index_rows(filings)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
