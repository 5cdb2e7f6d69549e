"""A positional inverted index of documents: ``term, doc_id, places`` as a table.

Rows are laid out by ranges of (term, document) and sorted, so the statistics of files and
row groups lead a search to the postings of its words, and the postings of a word that
stands in most documents are spread over as many files as they fill.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.functions.columns import ColumnLike, as_column
from docketspark.session import scratch_dir

POSTINGS = "term string, doc_id bigint, places array<int>"
# Letters and digits; everything else separates words.
WORD = r"[\p{L}\p{N}]+"
# A file holds about so many postings.
FILE_POSTINGS = 4_000_000
# Documents whose words a task sorts at a time.
_SORTED = 256


def words_of(text: ColumnLike):
    """The words of a text in lower case, in order."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(WORD), F.lit(0))


def postings(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each word of each document once, with its sorted places (from 0), in ranges of
    (term, document).

    The places of a word are gathered where its document is read, so a row a word and
    document is moved, once, to its range. Null texts have no words; rows without an id
    cannot be found and are left out. Ids must be unique; the places of documents that
    repeat one are put together.
    """
    return _ranged(_words(documents, doc_id, text))


def _words(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The postings of each row of ``documents``."""

    def gather(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for start in range(0, frame.num_rows, _SORTED):
                batch = frame.slice(start, _SORTED)
                words = batch.column(1)
                coded = words.flatten().dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                if not len(codes):
                    continue
                sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                firsts = np.cumsum(sizes) - sizes
                rows = np.repeat(np.arange(len(sizes)), sizes)
                keys = rows * len(coded.dictionary) + codes
                order = np.argsort(keys, kind="stable")
                keys = keys[order]
                opens = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                places = (np.arange(len(codes)) - firsts[rows])[order].astype(np.int32)
                bounds = np.append(opens, len(codes)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        coded.dictionary.take(pa.array(codes[order[opens]])),
                        batch.column(0).take(pa.array(rows[order[opens]])),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(places)),
                    ],
                    names=["term", "doc_id", "places"],
                )

    named = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), words_of(text).alias("w"))
    return named.where("doc_id is not null").mapInArrow(gather, POSTINGS)


def _ranged(words: DataFrame, unique: bool = False) -> DataFrame:
    """A range partitioning by the grouping keys needs no second exchange. Where ids are
    ``unique`` there is nothing to put together."""
    ranged = words.repartitionByRange("term", "doc_id")
    if unique:
        return ranged
    places = F.sort_array(F.flatten(F.collect_list("places"))).alias("places")
    return ranged.groupBy("term", "doc_id").agg(places).select("term", "doc_id", "places")


def write_text_index(documents: DataFrame, table: str, batch: str, **names: str) -> None:
    """Add documents to the index; a batch that runs again replaces its own folder.

    The words are kept in the scratch folder first: the bounds of ranges are found by a pass
    of its own, which would take all texts apart a second time.
    """
    spark = documents.sparkSession
    _words(documents, **names).write.parquet(kept := scratch_dir(spark, "words"))
    words = spark.read.schema(POSTINGS).parquet(kept)
    # Of a document with words one posting begins with its first word.
    starts = words.where(F.get("places", F.lit(0)) == 0).groupBy("doc_id").count()
    rows = _ranged(words, unique=starts.where("count > 1").isEmpty()).sortWithinPartitions("term", "doc_id")
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", FILE_POSTINGS)
    writer.option("parquet.block.size", 16 << 20).parquet(f"{table.rstrip('/')}/batch={batch}")


def read_text_index(spark: SparkSession, table: str) -> DataFrame:
    try:
        return spark.read.schema(POSTINGS + ", batch string").parquet(table).drop("batch")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POSTINGS)
