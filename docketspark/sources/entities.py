"""Ticker files -> company keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions.columns import explode_parsed
from docketspark.functions.identifiers import cik10
from docketspark.schemas import TICKER_EXCHANGE, TICKER_RECORDS


def ticker_records(docs: DataFrame, text: str = "v") -> DataFrame:
    """``idx, ticker, cik`` from a map of numbered records."""
    parsed = F.from_json(F.col(text), TICKER_RECORDS)
    return explode_parsed(docs, parsed, ["idx", "record"]).select(
        F.col("idx").try_cast("bigint").alias("idx"),
        F.col("record.ticker").alias("ticker"),
        cik10(F.col("record.cik_str").cast("string")).alias("cik"),
    )


def ticker_exchange(docs: DataFrame, text: str = "v") -> DataFrame:
    """``cik, name, ticker, exchange`` from a header and rows; found by header name."""
    table = docs.select(F.from_json(F.col(text), TICKER_EXCHANGE).alias("t"))
    rows = explode_parsed(table, "t.data", ["row"]).select(F.col("t.fields").alias("fields"), "row")

    def field(name: str):
        # An absent header gives position -1, which ``get`` answers with null.
        return F.get("row", F.array_position("fields", name).cast("int") - 1)

    return rows.select(
        cik10(field("cik")).alias("cik"),
        field("name").alias("name"),
        field("ticker").alias("ticker"),
        field("exchange").alias("exchange"),
    )
