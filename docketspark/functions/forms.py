"""Form-type rules."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketspark.functions.columns import ColumnLike, as_column, blank_to_null

# Document type fetched by default for a form type.
PREFERRED_TYPE = {
    "S-1": "htm",
    "S-3": "htm",
    "F-1": "htm",
    "F-3": "htm",
    "10-Q": "xbrl",
    "10-K": "xbrl",
    "424A": "htm",
    "424B1": "htm",
    "424B2": "htm",
    "424B3": "htm",
    "424B4": "htm",
    "424B5": "htm",
    "424B7": "htm",
    "424B8": "htm",
    "4": "xml",
    "8-K": "htm",
    "EFFECT": "xml",
}
# Document types a caller may ask for.
DOCUMENT_TYPES = ["xml", "htm", "html", "xbrl", "txt"]
DEFAULT_TYPE = "htm"
AMENDMENT_SUFFIX = "/A"
HTML_SUFFIXES = ["htm", "html"]


def preferred_type(form_type: ColumnLike, requested: ColumnLike | None = None) -> Column:
    """The requested document type, else the form's default, else ``htm``."""
    defaults = F.create_map(*[F.lit(item) for item in chain.from_iterable(PREFERRED_TYPE.items())])
    choices = [F.element_at(defaults, as_column(form_type)), F.lit(DEFAULT_TYPE)]
    if requested is not None:
        choices.insert(0, blank_to_null(requested))
    return F.coalesce(*choices)


def is_amendment(form_type: ColumnLike) -> Column:
    return as_column(form_type).endswith(AMENDMENT_SUFFIX)


def base_form(form_type: ColumnLike) -> Column:
    """Form type without the amendment mark."""
    return F.regexp_replace(as_column(form_type), "/A$", "")


def is_form(form_type: ColumnLike, wanted: str | Iterable[str], amendments: bool) -> Column:
    """The wanted form itself, plus its amendments when asked for."""
    names = [wanted] if isinstance(wanted, str) else sorted(set(wanted))
    if amendments:
        names = names + [name + AMENDMENT_SUFFIX for name in names]
    return as_column(form_type).isin(names)


def within_dates(date: ColumnLike, after: str | None, before: str | None) -> Column:
    """Inclusive range; a blank bound is open."""
    date = as_column(date)
    test = F.lit(True)
    if after:
        test = test & (date >= F.lit(after).cast("date"))
    if before:
        test = test & (date <= F.lit(before).cast("date"))
    return test
