"""Small shared helpers for column arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: ColumnLike) -> Column:
    """Null for null, empty and all-blank strings."""
    value = as_column(value)
    return F.when(F.trim(value) != "", value)


def explode_parsed(df: DataFrame, value: ColumnLike, names: list[str]) -> DataFrame:
    """Add the elements of an array or map that may come from parsed text.

    A plain ``explode`` makes the optimizer test the value for emptiness first,
    below the parsing, so the text would be parsed once for the test and once
    for the rows. The outer form is not tested; its empty rows are dropped here.
    """
    exploded = df.select("*", F.explode_outer(as_column(value)).alias(*names))
    return exploded.where(F.col(names[0]).isNotNull())
