"""Company keys, accession numbers and stored-file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketspark.functions.columns import ColumnLike, as_column

ACCESSION_LENGTH = 18


def cik10(value: ColumnLike) -> Column:
    """Company key padded to ten digits; null when the value is not all digits.

    ``lpad`` would cut an eleven-digit value, so it only sees shorter ones.
    """
    digits = F.trim(as_column(value))
    padded = F.when(F.length(digits) < 10, F.lpad(digits, 10, "0")).otherwise(digits)
    return F.when(digits.rlike("^[0-9]+$"), padded)


def ticker_key(value: ColumnLike) -> Column:
    """Ticker in the form it is compared in."""
    return F.upper(F.trim(as_column(value)))


def accession(value: ColumnLike) -> Column:
    """Accession number without dashes; values of 18 characters stay as they are."""
    value = as_column(value)
    return F.when(F.length(value) == ACCESSION_LENGTH, value).otherwise(
        F.replace(value, F.lit("-"), F.lit(""))
    )


def file_name(path: ColumnLike) -> Column:
    """Last segment of a path."""
    return F.substring_index(as_column(path), "/", -1)


def file_suffix(path: ColumnLike) -> Column:
    """Suffix without the dot; empty for none and for names that only start with a dot."""
    return F.regexp_extract(as_column(path), r"[^./][^/]*[.]([^./]+)$", 1)


def safe_form(form_type: ColumnLike) -> Column:
    """Form type usable as a path segment: ``S-1/A`` becomes ``S-1.A``."""
    return F.translate(as_column(form_type), "/", ".")


def relative_path(
    cik: ColumnLike, form_type: ColumnLike, accession_number: ColumnLike, name: ColumnLike
) -> Column:
    """``cik/form/accession/file``; null if a part is missing."""
    parts = [as_column(cik), safe_form(form_type), accession(accession_number), as_column(name)]
    pieces: list[Column] = []
    for part in parts:
        pieces += [part, F.lit("/")]
    return F.concat(*pieces[:-1])


def absolute_path(root: str, path: ColumnLike) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/filings/"), as_column(path))


def accession_from_path(path: ColumnLike) -> Column:
    """The deepest folder of a path that is an accession number, else null."""
    path = F.translate(as_column(path), "\\", "/")
    # Nearly always it is the folder of the file itself.
    nearest = accession(F.substring_index(F.substring_index(path, "/", -2), "/", 1))
    is_nearest = path.contains("/") & (F.length(nearest) == ACCESSION_LENGTH)
    segments = F.split(path, "/")
    folders = F.slice(segments, F.lit(1), F.greatest(F.size(segments) - 1, F.lit(0)))
    candidates = F.transform(F.reverse(folders), accession)
    deepest = F.get(F.filter(candidates, lambda name: F.length(name) == ACCESSION_LENGTH), 0)
    return F.when(is_nearest, nearest).otherwise(deepest)
