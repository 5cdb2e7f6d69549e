"""A training-data pipeline: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.llm import boilerplate, compression, ngram_join, packing, quality_rules
from docketspark.llm.common import stored

# Rows of an Arrow batch in the pipeline's session: five stages share executors, and batches
# of 10,000 whole documents would stand beside each other in them.
BATCH_ROWS = "256"
# Rows of whole documents that a Parquet reader holds at a time, for the same reason.
READER_ROWS = "512"


def _session(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READER_ROWS)
    return spark


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees keep."""
    labels = _session(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.learn(docs, labels))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier predicts to be good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return compression.keep_good(docs, compression.learn(docs, labels))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents of their source share, and without
    long passages that an earlier document has; ``n_chars`` counts what is left."""
    freed = boilerplate.drop_boilerplate(docs, F.col("source"))
    counted = freed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return counted.select(*docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity connect."""
    return ngram_join.one_of_each(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: a row per piece of a document, with its ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("packing", packing_stage),
]

# SQL can express neither the fitted models nor the tokenizer; tests/llm compares the
# stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = _session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
