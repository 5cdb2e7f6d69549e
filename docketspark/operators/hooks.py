"""User functions called with each retrieved filing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def for_each_filing(filings: DataFrame, function: Callable[[dict[str, Any]], None]) -> None:
    """Call ``function`` with every filing as a dict, on the executors.

    A task that is run again calls it again: the function should be repeatable.
    """

    def call(rows: Iterator) -> None:
        for row in rows:
            function(row.asDict(recursive=True))

    filings.foreachPartition(call)


def map_filings(
    filings: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
) -> DataFrame:
    """Transform filings batch by batch with a pandas function."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return filings.mapInPandas(apply, schema)
