"""Links in HTML, found and rewritten with JVM string functions only.

The text is cut into tokens whose concatenation is the text again: link tags
(``a`` and ``img``), parts a link must not be looked for in (comments, scripts,
styles, text areas, titles) and everything between. Only link tags are touched,
so the rest of the document keeps its exact source.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketspark.functions.columns import ColumnLike, as_column
from docketspark.functions.urls import resolve_url

# Possessive loops (``++``, ``*+``) run without recursion in the Java matcher,
# so long documents cannot exhaust its stack.
_TAG_BODY = r"""(?:"[^"]*+"|'[^']*+'|[^'">]++)*+>"""
_COMMENT = r"<!--.*?(?:-->|\z)"
_RAW = r"<(script|style|textarea|title)(?=[\s/>]).*?(?:</\1\s*+>|\z)"
_LINK = r"<(?:a|img)(?=[\s/])" + _TAG_BODY
# Text, other tags, declarations, and a "<" that opens nothing.
_OTHER = (
    r"(?:[^<]++|<(?![a-z/!?])|<[!?](?<!<!(?=--))[^>]*+>?+"
    r"|<(?=[a-z/])(?!(?:script|style|textarea|title)[\s/>]|(?:a|img)[\s/])(?:"
    + _TAG_BODY
    + r")?+)++"
)
_TOKEN = f"(?is){_COMMENT}|{_RAW}|{_LINK}|{_OTHER}|<"

_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""


def _up_to(attribute: str) -> str:
    """The attributes before this one; values are passed over whole."""
    here = rf"[\s/]{attribute}\s*+="
    return rf"""(?:(?!{here})(?:=\s*+{_VALUE}|[^\s=>/"']++|["'\s/=]))*+{here}"""


_ADDRESS = (
    rf"(?is)^(<(?:a(?=[\s/]){_up_to('href')}|img(?=[\s/]){_up_to('src')})\s*+)"
    + f"({_VALUE}|)"
)


def html_tokens(html: ColumnLike) -> Column:
    return F.regexp_extract_all(as_column(html), F.lit(_TOKEN), F.lit(0))


def is_link_tag(token: ColumnLike) -> Column:
    """A link tag that carries an address."""
    return as_column(token).rlike(_ADDRESS)


def link_tag_name(token: ColumnLike) -> Column:
    return F.lower(F.regexp_extract(as_column(token), r"^<([A-Za-z]+)", 1))


def _unquoted(value: Column) -> Column:
    inner = F.substring(value, F.lit(2), F.length(value) - 2)
    return F.when(value.rlike("""^["']"""), inner).otherwise(value)


def link_address(token: ColumnLike) -> Column:
    """The address in a link tag, without quotes and surrounding blanks."""
    return F.trim(_unquoted(F.regexp_extract(as_column(token), _ADDRESS, 2)))


def _rewritten(token: Column, base: Column) -> Column:
    head = F.regexp_extract(token, _ADDRESS, 1)
    value = F.regexp_extract(token, _ADDRESS, 2)
    quote = F.when(value.startswith("'"), F.lit("'")).otherwise(F.lit('"'))
    start = F.length(head) + F.length(value) + 1
    rest = F.substring(token, start, F.length(token))
    address = resolve_url(base, link_address(token))
    return F.concat(head, quote, address, quote, rest)


def rewrite_links(html: ColumnLike, base: ColumnLike) -> Column:
    """HTML with the addresses of ``a`` and ``img`` made absolute."""
    base = as_column(base)
    tokens = F.transform(
        html_tokens(html),
        lambda token: F.when(is_link_tag(token), _rewritten(token, base)).otherwise(token),
    )
    return F.array_join(tokens, "")
