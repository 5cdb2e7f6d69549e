"""Splitting of hot groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group is hot when it holds more rows than this.
HOT_ROWS = 1_000_000
# Most groups that are spread. Any other group has less than this fraction of all rows.
HOT_GROUPS = 100_000

def group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, group_rows``; counted before anything is shuffled."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"))


def hot_groups(sizes: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``keys, _parts`` of the largest groups, those too large for one task.

    At most ``HOT_GROUPS`` however large the data is, so the list always fits the
    driver and a broadcast. A group not among that many largest ones holds less
    than one in ``HOT_GROUPS`` of all rows and needs no spreading.
    """
    hot = sizes.where(F.col("group_rows") > hot_rows)
    largest = hot.orderBy(F.col("group_rows").desc(), *keys).limit(HOT_GROUPS)
    parts = F.ceil(F.col("group_rows") / F.lit(hot_rows)).cast("int")
    return largest.select(*keys, parts.alias("_parts"))


def join_hot(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Join (inner, left or left_semi) whose hot groups of ``left`` span several tasks.

    The hot groups are part of the plan: their list, which has a bound, is broadcast to
    both sides. The rows of a hot group get one of its parts, and the rows of ``right``, one
    or a few per key, are repeated once per part. The join key includes the part, so
    neither the join nor an operator that reuses its partitioning sees a whole hot group.
    This is spelled out because the adaptive skew join leaves a join alone when one of its
    sides is an aggregate on the same key. ``sizes`` may give group sizes that are cheaper
    to find than those of ``left``; too large a size does no harm.

    Keys with nulls are spread like others. They match nothing, as in any join, unless
    ``null_safe``: then null equals null.
    """
    sizes = group_sizes(left, on) if sizes is None else sizes
    names = {key: f"_hot_{key}" for key in on}
    hot = hot_groups(sizes, on, hot_rows)
    hot = F.broadcast(hot.select(*[F.col(k).alias(n) for k, n in names.items()], "_parts"))

    def with_parts(df: DataFrame) -> DataFrame:
        known = reduce(lambda a, b: a & b, [df[k].eqNullSafe(hot[n]) for k, n in names.items()])
        found = df.join(hot, known, "left").drop(*names.values())
        return found.withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    part = F.pmod(F.xxhash64(*spread_by), F.col("_parts").cast("bigint")).cast("int")
    spread = with_parts(left).withColumn("_part", part).drop("_parts")
    repeated = (
        with_parts(right)
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .drop("_parts")
    )
    if not null_safe:
        return spread.join(repeated, [*on, "_part"], how).drop("_part")
    repeated = repeated.withColumnsRenamed({k: f"_right_{k}" for k in [*on, "_part"]})
    matches = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in [*on, "_part"]]
    joined = spread.join(repeated, reduce(lambda a, b: a & b, matches), how)
    return joined.drop("_part", *[f"_right_{k}" for k in [*on, "_part"]])


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of keys where null equals null; still usable as a hash-join key."""
    return reduce(lambda a, b: a & b, [left[key].eqNullSafe(right[key]) for key in keys])
