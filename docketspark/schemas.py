"""Explicit schemas. Identifiers are always strings: form types such as ``4`` or
``144`` and zero-padded company keys do not survive type inference."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_STRINGS = T.ArrayType(_S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One document per company (or per page of a large company); ``recent`` holds
# parallel arrays, one element per filing.
RECENT_FIELDS = ["form", "accessionNumber", "filingDate", "primaryDocument", "fileNumber"]
SUBMISSION = _struct(
    cik=_S,
    filings=_struct(recent=_struct(**{name: _STRINGS for name in RECENT_FIELDS})),
)

SEARCH_HIT = _struct(
    _id=_S,
    _source=_struct(
        ciks=_STRINGS, file_num=_STRINGS, xsl=_S, file_date=_S, form=_S, root_form=_S, file_type=_S
    ),
)
SEARCH_RESULT = _struct(
    hits=_struct(hits=T.ArrayType(SEARCH_HIT)),
    query=_struct(size=T.LongType()),
    error=_struct(root_cause=T.ArrayType(_struct(reason=_S))),
)

TICKER_RECORDS = T.MapType(_S, _struct(cik_str=T.LongType(), ticker=_S))
TICKER_EXCHANGE = _struct(fields=_STRINGS, data=T.ArrayType(_STRINGS))

FACT = _struct(
    val=_S,  # as it is written; a double beside it is derived
    start=_S,
    end=_S,
    accn=_S,
    fy=T.LongType(),
    fp=_S,
    form=_S,
    filed=_S,
    frame=_S,
)
CONCEPT = _struct(label=_S, description=_S, units=T.MapType(_S, T.ArrayType(FACT)))
COMPANY_FACTS = _struct(
    cik=T.LongType(), entityName=_S, facts=T.MapType(_S, T.MapType(_S, CONCEPT))
)

INDEX_COLUMNS = ["cik", "form_type", "file_number", "file_path", "filing_date"]
INDEX = _struct(cik=_S, form_type=_S, file_number=_S, file_path=_S, filing_date=T.DateType())
# An entry is the same entry when these agree.
INDEX_KEY = ["cik", "form_type", "file_number", "file_path"]

INDEX_CSV = _struct(form_type=_S, file_number=_S, file_path=_S, filing_date=_S)
# file number -> list of [form type, path, filing date]
FILE_NUMBER_MAP = T.MapType(_S, T.ArrayType(_STRINGS))
