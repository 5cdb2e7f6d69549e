"""Search results -> hits and filing metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.functions.columns import blank_to_null, explode_parsed
from docketspark.functions.identifiers import accession, safe_form
from docketspark.functions.urls import filing_base_url
from docketspark.schemas import SEARCH_RESULT


def read_search_results(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed result envelopes, one JSON document per file."""
    return spark.read.schema(SEARCH_RESULT).option("multiLine", True).json(path)


def parse_search_results(docs: DataFrame, text: str = "v") -> DataFrame:
    envelope = F.from_json(F.col(text), SEARCH_RESULT)
    return docs.select(envelope.alias("e")).select("e.hits", "e.query", "e.error")


def search_hits(results: DataFrame) -> DataFrame:
    """One row per hit of the results that are not errors."""
    hits = explode_parsed(results, F.when(F.col("error").isNull(), F.col("hits.hits")), ["hit"])
    source = F.col("hit._source")
    return hits.select(
        F.col("hit._id").alias("hit_id"),
        source["ciks"].alias("ciks"),
        source["file_num"].alias("file_num"),
        source["xsl"].alias("xsl"),
        source["file_date"].try_cast("date").alias("filing_date"),
        source["form"].alias("form"),
        source["root_form"].alias("root_form"),
        source["file_type"].alias("file_type"),
    )


def search_rejects(results: DataFrame) -> DataFrame:
    """Why a search gave no hits: one row per error, or per result without hits and error
    (text that is no JSON, or another document)."""
    reason = F.get(F.col("error.root_cause"), 0)["reason"]
    failed = F.col("error").isNotNull()
    empty = F.col("hits.hits").isNull()
    told = F.when(failed, F.coalesce(reason, F.lit("error without a reason")))
    rows = results.where(failed | empty)
    return rows.select(F.coalesce(told, F.lit("neither hits nor an error")).alias("reason"))


def hit_metadata(hits: DataFrame) -> DataFrame:
    """Hits as filing metadata; other columns of the hits are kept."""
    parts = F.split("hit_id", ":", 2)
    form = F.coalesce(blank_to_null("form"), F.col("root_form"))
    derived = ["hit_id", "ciks", "file_num", "xsl", "filing_date", "form", "file_type"]
    passed = [name for name in hits.columns if name not in derived]
    return hits.select(
        *passed,
        safe_form(form).alias("form_type"),
        accession(F.get(parts, 0)).alias("accession_number"),
        F.try_element_at("ciks", F.lit(-1)).alias("cik"),
        F.get(parts, 1).alias("main_file_name"),
        blank_to_null("xsl").alias("xsl"),
        "file_num",
        "filing_date",
    ).withColumn("base_url", filing_base_url("cik", "accession_number"))
