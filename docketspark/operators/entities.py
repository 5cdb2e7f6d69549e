"""Tickers to company keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions.identifiers import cik10, ticker_key
from docketspark.functions.skew import join_hot

_NO_TICKER_PARTS = 4096


def ticker_map(records: DataFrame) -> DataFrame:
    """One company per ticker: the record with the highest number wins.

    Of records with the same number the greatest company key wins, whatever their order;
    a record without a number comes before all others.
    """
    last = F.max(F.struct(F.coalesce("idx", F.lit(-1)).alias("idx"), "cik"))
    return (
        records.where(F.col("ticker").isNotNull())
        .groupBy(ticker_key("ticker").alias("ticker"))
        .agg(last.alias("last"))
        .select("ticker", F.col("last.cik").alias("cik"))
    )


def resolve_companies(
    queries: DataFrame, tickers: DataFrame, column: str = "ticker_or_cik"
) -> DataFrame:
    """Add ``cik``: numeric ids are padded, tickers looked up, unknown ones give null.

    ``tickers`` is the result of ``ticker_map``, one row per ticker. Numeric ids
    need no look-up; they get keys that match nothing and spread over the
    partitions, where null keys would all meet in one.
    """
    numeric = cik10(column)
    nowhere = F.concat(
        F.lit("\t"), F.pmod(F.xxhash64(column), F.lit(_NO_TICKER_PARTS)).cast("string")
    )
    is_ticker = numeric.isNull() & F.col(column).isNotNull()
    key = F.when(is_ticker, ticker_key(column)).otherwise(nowhere)
    lookup = tickers.select(F.col("ticker").alias("_key"), F.col("cik").alias("_cik"))
    keyed = queries.withColumn("_key", key)
    found = join_hot(keyed, lookup, ["_key"], queries.columns, "left")
    return found.withColumn("cik", F.coalesce(numeric, F.col("_cik"))).drop("_key", "_cik")


def unresolved(resolved: DataFrame) -> DataFrame:
    """The reject report of ``resolve_companies``."""
    return resolved.where(F.col("cik").isNull()).drop("cik")
