"""Document addresses: where a filing's files are, and reference resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketspark.functions.columns import ColumnLike, as_column
from docketspark.functions.forms import HTML_SUFFIXES

# Public addresses of the filing archive and its data service.
ARCHIVE = "https://www.sec.gov/Archives/edgar/data"
COMPANY_FACTS = "https://data.sec.gov/api/xbrl/companyfacts"
COMPANY_CONCEPT = "https://data.sec.gov/api/xbrl/companyconcept"
BULK_COMPANY_FACTS = "https://www.sec.gov/Archives/edgar/daily-index/xbrl/companyfacts.zip"
BULK_SUBMISSIONS = "https://www.sec.gov/Archives/edgar/daily-index/bulkdata/submissions.zip"
COMPANY_TICKERS = "https://www.sec.gov/files/company_tickers.json"
COMPANY_TICKERS_EXCHANGE = "https://www.sec.gov/files/company_tickers_exchange.json"
SECURITY_LIST_UNTIL_2021Q1 = "https://www.sec.gov/divisions/investment/13f"
SECURITY_LIST_SINCE_2021Q2 = "https://www.sec.gov/files/investment"


def join_url(*parts: ColumnLike) -> Column:
    """Parts joined by ``/``; null if a part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [as_column(part), F.lit("/")]
    return F.concat(*pieces[:-1])


def filing_base_url(cik: ColumnLike, accession_number: ColumnLike) -> Column:
    return join_url(F.lit(ARCHIVE), cik, accession_number)


def company_facts_url(cik: ColumnLike) -> Column:
    return F.concat(F.lit(COMPANY_FACTS + "/CIK"), as_column(cik), F.lit(".json"))


def company_concept_url(cik: ColumnLike, taxonomy: ColumnLike, tag: ColumnLike) -> Column:
    folder = F.concat(F.lit(COMPANY_CONCEPT + "/CIK"), as_column(cik))
    return F.concat(join_url(folder, taxonomy, tag), F.lit(".json"))


def security_list_url(year: ColumnLike, quarter: ColumnLike) -> Column:
    """Quarterly list of securities; its folder changed with the second quarter of 2021."""
    year, quarter = as_column(year), as_column(quarter)
    folder = F.when(
        (year > 2021) | ((year == 2021) & (quarter >= 2)), F.lit(SECURITY_LIST_SINCE_2021Q2)
    ).otherwise(F.lit(SECURITY_LIST_UNTIL_2021Q1))
    return F.concat(
        folder,
        F.lit("/13flist"),
        year.cast("string"),
        F.lit("q"),
        quarter.cast("string"),
        F.lit(".pdf"),
    )


def file_url(
    base_url: ColumnLike,
    accession_number: ColumnLike,
    main_file: ColumnLike,
    suffix: ColumnLike,
    preferred: ColumnLike,
    skip_not_preferred: bool,
) -> Column:
    """Address of the preferred document; null when it does not exist and must be skipped."""
    main_file, preferred, suffix = as_column(main_file), as_column(preferred), as_column(suffix)
    both_html = suffix.isin(HTML_SUFFIXES) & preferred.isin(HTML_SUFFIXES)
    # Only the end of the name changes; a name without a suffix gets one.
    stem = F.when(suffix == "", F.concat(main_file, F.lit("."))).otherwise(
        F.left(main_file, F.length(main_file) - F.length(suffix))
    )
    name = (
        F.when((suffix == preferred) | both_html, main_file)
        .when(preferred == "xbrl", F.concat(as_column(accession_number), F.lit("-xbrl.zip")))
        .when(preferred == "txt", F.concat(stem, F.lit("txt")))
    )
    return join_url(base_url, name if skip_not_preferred else name.otherwise(main_file))


def _fold_dots(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments from an absolute path."""
    segments = F.split(path, "/")
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, segment: F.when(segment == ".", kept)
        .when(
            segment == "..",
            F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))),
        )
        .otherwise(F.concat(kept, F.array(segment))),
    )
    joined = F.array_join(folded, "/")
    # A final dot segment names a folder.
    return F.when(path.rlike(r"/\.\.?$"), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve_url(base: ColumnLike, reference: ColumnLike) -> Column:
    """Resolve a link against the address of its document (RFC 3986, section 5).

    Links with a scheme (``http:``, ``mailto:``, ``javascript:``) and links to a
    place in the same document (``#…``) are left alone.
    """
    base = as_column(base)
    reference = F.trim(as_column(reference))
    scheme = F.regexp_extract(base, r"^([^:/?#]+:)", 1)
    origin = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*)", 1)
    # Past the origin, up to the query or fragment.
    base_path = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(base_path, r"^/?(.*/)?[^/]*$", 1))
    path = F.regexp_extract(reference, r"^([^?#]*)", 1)
    tail = F.regexp_extract(reference, r"^[^?#]*(.*)$", 1)
    full = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    clean = F.when(full.rlike(r"/\.\.?(/|$)"), _fold_dots(full)).otherwise(full)
    return (
        F.when((origin == "") | reference.rlike(r"^(#|[A-Za-z][A-Za-z0-9+.-]*:)"), reference)
        .when(reference.startswith("//"), F.concat(scheme, reference))
        .when(reference == "", F.regexp_extract(base, r"^([^#]*)", 1))
        .when(path == "", F.concat(origin, base_path, tail))
        .otherwise(F.concat(origin, clean, tail))
    )
