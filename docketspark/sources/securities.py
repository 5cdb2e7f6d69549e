"""Quarterly 13F security lists."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.functions.columns import ColumnLike, as_column
from docketspark.functions.skew import join_hot
from docketspark.functions.urls import security_list_url


def security_list_urls(dates: DataFrame, date: ColumnLike) -> DataFrame:
    """The list valid at each date: ``year, quarter, url``, one row per quarter."""
    date = as_column(date).cast("date")
    quarters = dates.where(date.isNotNull()).select(
        F.year(date).alias("year"), F.quarter(date).alias("quarter")
    )
    return quarters.distinct().withColumn("url", security_list_url("year", "quarter"))


def security_list_address(
    year: int | None, quarter: int | None, today: datetime.date
) -> Column:
    """Address of one list; without year and quarter, of the one current at ``today``."""
    if (year is None) != (quarter is None):
        raise ValueError("give both year and quarter, or neither")
    if quarter is not None and quarter not in (1, 2, 3, 4):
        raise ValueError(f"quarter must be 1 to 4, got {quarter}")
    if year is None:
        year, quarter = today.year, (today.month + 2) // 3
    return security_list_url(F.lit(year), F.lit(quarter))


def security_rows(cells: DataFrame) -> DataFrame:
    """Extracted ``table_id, row_no, cells`` -> ``cusip, issuer, description``.

    Extraction gives tables of five columns (the second holds a mark) or four;
    the last column is the status. A table's width is that of its widest row,
    counted before the shuffle; other widths keep their cells.
    """
    widths = cells.groupBy("table_id").agg(F.max(F.size("cells")).alias("width"))
    cell = F.col("cells")
    kept = (
        F.when(F.col("width") == 5, F.array(F.get(cell, 0), F.get(cell, 2), F.get(cell, 3)))
        .when(F.col("width") == 4, F.array(F.get(cell, 0), F.get(cell, 1), F.get(cell, 2)))
        .otherwise(cell)
    )
    joined = join_hot(cells, widths, ["table_id"], ["row_no"], null_safe=True)
    rows = joined.select("table_id", "row_no", kept.alias("cells"))
    names = ["cusip", "issuer", "description"]
    return rows.select(
        "table_id", "row_no", "cells", *[F.get("cells", i).alias(n) for i, n in enumerate(names)]
    )
