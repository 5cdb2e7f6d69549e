"""Which filings: by form, date, company, text, and the newest of each group."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketspark.functions.columns import ColumnLike, as_column
from docketspark.functions.forms import base_form, is_form, within_dates
from docketspark.functions.identifiers import cik10
from docketspark.functions.skew import join_hot

NEWEST_FIRST = ["filing_date", "accession_number", "main_file_name"]


def newer_filings(
    filings: DataFrame, after: str, tracked: Iterable[str] | None = None
) -> DataFrame:
    """Filings dated ``after`` or later, of the tracked forms; all forms when not given."""
    newer = filings.where(within_dates("filing_date", after, None))
    if tracked is None:
        return newer
    return newer.where(F.col("form_type").isin(sorted(set(tracked))))


def filings_per_company(filings: DataFrame) -> DataFrame:
    """Count and date span per company and form."""
    return filings.groupBy("cik", "form_type").agg(
        F.count(F.lit(1)).alias("n_filings"),
        F.min("filing_date").alias("first_date"),
        F.max("filing_date").alias("last_date"),
    )


def of_companies(rows: DataFrame, companies: DataFrame, key: str = "cik") -> DataFrame:
    """Rows of the listed companies. The list may hold repeats and short keys."""
    wanted = companies.select(cik10(companies[key].cast("string")).alias("cik")).distinct()
    return join_hot(rows, wanted, ["cik"], rows.columns, "left_semi")


def select_hits(
    hits: DataFrame,
    form_type: str | Iterable[str],
    after: str | None = None,
    before: str | None = None,
    amendments: bool = True,
) -> DataFrame:
    """Hits of a form, with or without its amendments, in an inclusive date range."""
    return hits.where(
        is_form("file_type", form_type, amendments) & within_dates("filing_date", after, before)
    )


def matches_text(text: ColumnLike, query: str):
    """All words and quoted phrases of ``query`` occur in the text, in any letter case."""
    found = F.lit(True)
    lowered = F.lower(as_column(text))
    for phrase, word in re.findall(r'"([^"]+)"|([^\s"]+)', query):
        found = found & lowered.contains((phrase or word).lower())
    return found


def newest(filings: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` filings of all."""
    return filings.orderBy(*[F.col(name).desc() for name in NEWEST_FIRST]).limit(n)


# Parts of a group that are ranked by themselves before the group is.
RANK_PARTS = 16


def newest_per_group(filings: DataFrame, group: list[str], n: int) -> DataFrame:
    """The newest ``n`` filings of each group, with their ``rank``; null keys are groups too.

    A rank test against a literal lets Spark keep ``n`` rows per group in every
    map task before it shuffles. A group's parts are ranked first, so the task that
    ranks a group of any size sees at most ``n`` rows of each part. Spark limits the rows
    before the shuffle up to a bound on ``n``; beyond it, older filings are dropped by
    date before the ranking.
    """
    limit = filings.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if n > int(limit):
        filings = _since_nth_newest(filings, group, n)
    newest_first = [F.col(name).desc() for name in NEWEST_FIRST]
    part = F.pmod(F.xxhash64(*NEWEST_FIRST), F.lit(RANK_PARTS))
    within = Window.partitionBy(*group, "_part").orderBy(*newest_first)
    parts = filings.withColumn("_part", part).withColumn("_rank", F.row_number().over(within))
    candidates = parts.where(F.col("_rank") <= n).drop("_part", "_rank")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*newest_first))
    return candidates.withColumn("rank", rank).where(F.col("rank") <= n)


def _since_nth_newest(filings: DataFrame, group: list[str], n: int) -> DataFrame:
    """Filings of each group from the day of its ``n``-th newest on.

    Days are counted before anything is ranked, so a window sees one row per day.
    """
    day = F.coalesce("filing_date", F.lit("0001-01-01").cast("date"))
    filings = filings.withColumn("_day", day)
    days = filings.groupBy(*group, "_day").agg(F.count(F.lit(1)).alias("_rows"))
    newer = Window.partitionBy(*group).orderBy(F.col("_day").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    needed = days.withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
    first = needed.where(F.col("_newer") < n).groupBy(*group).agg(F.min("_day").alias("_first"))
    spread_by = ["accession_number", "main_file_name"]
    dated = join_hot(filings, first, group, spread_by, null_safe=True)
    return dated.where(F.col("_day") >= F.col("_first")).drop("_day", "_first")


def unknown_forms(filings: DataFrame, known: DataFrame, form: str = "form_type") -> DataFrame:
    """Forms outside the known list (column ``form_type``), with their counts.

    Forms are counted before they are compared, so the join sees each form once
    (an anti join would be moved below the counting). Amendments count as their
    base form.
    """
    counts = filings.groupBy(base_form(form).alias("form_type")).agg(
        F.count(F.lit(1)).alias("n_filings")
    )
    names = known.select("form_type").distinct().withColumn("_known", F.lit(True))
    return counts.join(names, "form_type", "left").where(F.col("_known").isNull()).drop("_known")


def _shortened(names: Column, times: int) -> Column:
    """The names and all that is left of them when up to ``times`` signs are taken away."""
    out = names
    for _ in range(times):
        less = F.transform(
            names,
            lambda name: F.transform(
                F.filter(F.sequence(F.lit(1), F.length(name) + 1), lambda i: i <= F.length(name)),
                lambda i: F.concat(F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, F.length(name))),
            ),
        )
        names = F.array_distinct(F.flatten(less))
        out = F.concat(out, names)
    return F.array_distinct(out)


def nearest_known(
    unknown: DataFrame, known: DataFrame, max_distance: int = 2, form: str = "form_type"
) -> DataFrame:
    """``unknown`` (distinct forms) with the known form it was most likely meant to be:
    ``nearest`` and ``distance`` (edits), null where none is within ``max_distance`` edits.
    Of equally near ones the first by name.

    Names within so many edits share what is left of them when as many signs are taken away
    from each, so only names that meet there are compared, never all with all. A name of n
    signs has about n ** max_distance / 2 such remains. Names are compared in upper case; a
    null form has no nearest one, and null names are no names.
    """
    names = known.where(F.col(form).isNotNull()).select(F.col(form).alias("_name")).distinct()
    upper = _shortened(F.array(F.upper("_name")), max_distance)
    left = names.select("_name", F.explode(upper).alias("_rest"))
    asked = unknown.where(F.col(form).isNotNull()).select(F.col(form).alias("_asked")).distinct()
    rest = _shortened(F.array(F.upper("_asked")), max_distance)
    right = asked.select("_asked", F.explode(rest).alias("_rest"))
    pairs = right.join(left, "_rest").select("_asked", "_name").distinct()
    distance = F.levenshtein(F.upper("_asked"), F.upper("_name"))
    near = pairs.withColumn("_distance", distance).where(F.col("_distance") <= max_distance)
    best = near.groupBy("_asked").agg(F.min(F.struct("_distance", "_name")).alias("_best"))
    found = unknown.join(best, F.col(form) == F.col("_asked"), "left")
    return found.withColumns({"nearest": F.col("_best._name"), "distance": F.col("_best._distance")}).drop("_asked", "_best")
