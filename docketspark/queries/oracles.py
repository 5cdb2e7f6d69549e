"""The same results in plain SQL over the test tables."""

from __future__ import annotations

_VIEWS = {
    "v_filings": """
        select o_orderkey as order_no,
               lpad(cast(o_custkey as varchar), 10, '0') as cik,
               lpad(cast(o_orderkey as varchar), 18, '0') as accession_number,
               case o_orderstatus when 'F' then '10-K' when 'O' then '10-Q' else 'S-1' end
                 as root_form,
               case o_orderstatus when 'F' then '10-K' when 'O' then '10-Q' else 'S-1' end
                 || case when o_orderpriority = '1-URGENT' then '/A' else '' end as file_type,
               '001-' || lpad(cast(o_orderkey % 7 as varchar), 5, '0') as file_number,
               cast(cast(o_orderdate as date) as varchar) as filing_date,
               'd' || cast(o_orderkey as varchar)
                 || case o_orderkey % 5 when 0 then '.htm' when 1 then '.html' when 2 then '.xml'
                    when 3 then '.txt' else '.pdf' end as main_file_name,
               case o_orderkey % 5 when 0 then 'htm' when 1 then 'html' when 2 then 'xml'
                    when 3 then 'txt' else 'pdf' end as suffix,
               'https://www.sec.gov/Archives/edgar/data/'
                 || lpad(cast(o_custkey as varchar), 10, '0') || '/'
                 || lpad(cast(o_orderkey as varchar), 18, '0') as base_url
        from orders""",
    # Filings by block of a company; the last block is the recent one.
    "v_blocks": """
        select *, order_no // 256 as page,
               max(order_no // 256) over (partition by cik) as last
        from v_filings""",
    "v_index": """
        select cik, replace(file_type, '/', '.') as form_type, file_number,
               cik || '/' || replace(file_type, '/', '.') || '/' || accession_number || '/'
                 || main_file_name as file_path,
               filing_date, accession_number
        from v_filings""",
    "v_index_dup": """
        select cik, form_type, file_number, file_path, filing_date from v_index
        union all
        select cik, form_type, file_number, file_path, filing_date from v_index
        where right(cik, 1) = '0'""",
    "v_present": """
        select file_path from v_index
        where cast(right(accession_number, 4) as int) % 11 <> 0""",
    # Accession numbers that hold the year of filing; n is what is left of the order number.
    "v_index_years": """
        select cik, replace(file_type, '/', '.') as form_type, file_number,
               cik || '/' || replace(file_type, '/', '.') || '/' || cik
                 || substr(filing_date, 3, 2) || right(accession_number, 6) || '/'
                 || main_file_name as file_path,
               filing_date, cast(right(accession_number, 6) as int) as n
        from v_filings""",
    "v_tickers": """
        select 'T' || cast(s_suppkey % 60 as varchar) as ticker,
               lpad(cast(max(s_suppkey) as varchar), 10, '0') as cik
        from supplier group by 1""",
    "v_queries": """
        select c_custkey as q_id,
               case when c_custkey % 2 = 0 then 't' || cast(c_custkey % 70 as varchar)
                    else cast(c_custkey as varchar) end as ticker_or_cik
        from customer""",
    "v_resolved": """
        select q.q_id, q.ticker_or_cik,
               case when q.q_id % 2 = 1 then
                      case when length(q.ticker_or_cik) < 10
                           then lpad(q.ticker_or_cik, 10, '0') else q.ticker_or_cik end
                    else t.cik end as cik
        from v_queries q left join v_tickers t on upper(q.ticker_or_cik) = t.ticker""",
    # Preferred document type by root form: 10-K and 10-Q come as archives.
    "v_plan": """
        select *,
               case when root_form in ('10-K', '10-Q') then 'xbrl' else 'htm' end
                 as preferred_type,
               base_url || '/' || main_file_name as fallback_url,
               base_url || '/' || case when root_form in ('10-K', '10-Q')
                 then accession_number || '-xbrl.zip' else main_file_name end as file_url
        from v_filings""",
    "v_number": """
        select order_no, cast(right(accession_number, 4) as int) as number from v_filings""",
    # The hits that the request of a company and form may take.
    "v_requests": """
        select distinct cik as request_cik,
               case when q_id % 3 = 0 then '10-Q' else '10-K' end as request_form,
               case when q_id % 4 >= 2 then '1996-01-01' end as request_after,
               case when q_id % 4 >= 2 then '1999-12-31' end as request_before
        from v_resolved where cik is not null""",
    "v_hits": """
        select cik as request_cik, * from v_filings
        union
        select '0000000001' as request_cik, * from v_filings""",
    "v_asked": """
        select h.*, r.request_form, r.request_after, r.request_before
        from v_hits h join v_requests r
          on h.request_cik = r.request_cik and h.root_form = r.request_form
         and h.filing_date between coalesce(r.request_after, '0001-01-01')
                               and coalesce(r.request_before, '9999-12-31')""",
}

_NEEDS = {
    "v_index_years": ["v_filings"],
    "v_blocks": ["v_filings"],
    "v_index": ["v_filings"],
    "v_index_dup": ["v_index"],
    "v_present": ["v_index"],
    "v_resolved": ["v_queries", "v_tickers"],
    "v_plan": ["v_filings"],
    "v_number": ["v_filings"],
    "v_requests": ["v_resolved"],
    "v_hits": ["v_filings"],
    "v_asked": ["v_hits", "v_requests"],
}


def _with(views: list[str], body: str) -> str:
    """The body preceded by the views it needs, in the order of ``_VIEWS``."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in _NEEDS.get(name, []):
                add(other)

    for view in views:
        add(view)
    parts = [f"{name} as ({sql})" for name, sql in _VIEWS.items() if name in wanted]
    return f"with {', '.join(parts)} {body}" if parts else body


_FILING = "cik, file_type as form_type, accession_number, main_file_name, filing_date"
_HIT = "accession_number || ':' || main_file_name as hit_id, cik, file_type, filing_date"
_ALL_INDEX = "cik, form_type, file_number, file_path, filing_date"

ORACLES = {
    "submissions_explode": _with(["v_filings"], f"select {_FILING}, file_number from v_filings"),
    # Documents of keys ending in 3 lack their file numbers.
    "submissions_malformed": _with(
        ["v_filings"],
        """select cik, n as form, n as "accessionNumber", n as "filingDate",
                  n as "primaryDocument", cast(0 as int) as "fileNumber"
           from (select cik, cast(count(*) as int) as n from v_filings
                 where right(cik, 1) = '3' group by cik, order_no // 65536)""",
    ),
    "newer_filings": _with(
        ["v_filings"],
        f"""select {_FILING} from v_filings
            where filing_date >= '2000-06-01' and file_type in ('10-K', '10-K/A', 'S-1')""",
    ),
    "newer_filings_by_company": _with(
        ["v_filings"],
        """select cik, file_type as form_type, count(*) as n_filings,
                  min(filing_date) as first_date, max(filing_date) as last_date
           from v_filings where filing_date >= '2000-06-01' group by 1, 2""",
    ),
    "newest_n_per_company": _with(
        ["v_filings"],
        f"""select * from (
              select {_FILING},
                     cast(row_number() over (partition by cik, file_type
                       order by filing_date desc, accession_number desc) as int) as rank,
                     base_url
              from v_filings) where rank <= 3""",
    ),
    "newest_n_large": _with(
        ["v_filings"],
        """select cik, form_type, accession_number, main_file_name, filing_date,
                  cast(rn as int) as rank
           from (select *, row_number() over (partition by cik, form_type
                        order by filing_date desc, accession_number desc, main_file_name desc) as rn
                 from (select case when order_no % 3 <> 0 then cik end as cik,
                              file_type as form_type, accession_number, main_file_name, filing_date
                       from v_filings))
           where rn <= 1001""",
    ),
    "filing_positions": _with(
        ["v_filings"],
        """select accession_number, row_number() over (partition by cik, order_no // 65536
                    order by filing_date desc, accession_number desc) - 1 as pos
           from v_filings""",
    ),
    "catalog_written": _with(["v_filings"], f"select {_FILING} from v_filings"),
    "newest_n_overall": _with(
        ["v_filings"],
        f"""select {_FILING} from v_filings
            order by filing_date desc, accession_number desc limit 100""",
    ),
    "filings_of_companies": _with(
        ["v_filings"],
        f"""select {_FILING} from v_filings where cik in (
              select lpad(cast(c_custkey as varchar), 10, '0') from customer
              where c_mktsegment = 'BUILDING')""",
    ),
    "search_hits_meta": _with(
        ["v_filings"],
        """select replace(file_type_or_root, '/', '.') as form_type, accession_number, cik,
                  base_url, main_file_name, cast(null as varchar) as xsl,
                  case when order_no % 6 = 0
                       then file_number || '|333-' || lpad(cast(order_no % 11 as varchar), 5, '0')
                       else file_number end as file_num, filing_date
           from (select *, case when file_type like '%/A' then root_form else file_type end
                   as file_type_or_root from v_filings)""",
    ),
    "search_rejects": "select 'no access: ' || c_name as reason from customer where c_acctbal < 0",
    "search_broken": """
        select kind, 'neither hits nor an error' as reason, sum(n)::bigint as n
        from (select count(distinct o_orderkey // 100) as n from orders
              union all select count(*) from customer where c_acctbal < 0),
             (select unnest(['cut', 'renamed']) as kind)
        group by kind""",
    "search_no_amendments": _with(
        ["v_filings"], f"select {_HIT} from v_filings where file_type = 'S-1'"
    ),
    "search_with_amendments": _with(
        ["v_filings"], f"select {_HIT} from v_filings where file_type in ('S-1', 'S-1/A')"
    ),
    "search_date_range": _with(
        ["v_filings"],
        f"""select {_HIT} from v_filings where root_form in ('10-K', '10-Q')
            and filing_date between '2000-06-01' and '2000-12-31'""",
    ),
    "text_search_documents": """
        select doc_id, lang, source, n_chars from documents
        where contains(lower(text), 'the') and contains(lower(text), 'in the')
          and contains(lower(text), 'er')""",
    # A phrase's matches: the text's words joined by tabs, cut at the phrase between tabs;
    # every tab is doubled, so neighbouring matches do not share one.
    "text_index_search": """
        with words as (
          select doc_id, '\t' || array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), '\t\t')
            || '\t' as w
          from documents
        ), asked as (
          select unnest([
            {'query': 'the', 'ps': [['the']]},
            {'query': '"in the"', 'ps': [['in', 'the']]},
            {'query': 'over "of the" a', 'ps': [['over'], ['of', 'the'], ['a']]},
            {'query': 'und "in der"', 'ps': [['und'], ['in', 'der']]},
            {'query': 'terms-of-use', 'ps': [['terms', 'of', 'use']]},
            {'query': 'the THE "the"', 'ps': [['the']]},
            {'query': 'zzzz the', 'ps': [['zzzz'], ['the']]}
          ]) as a
        ), hits as (
          select doc_id, a.query as query, list_transform(a.ps, lambda p:
            len(string_split(w, '\t' || array_to_string(p, '\t\t') || '\t')) - 1) as n
          from words, asked
        )
        select doc_id, cast(list_sum(n) as bigint) as n_matches, query from hits where list_min(n) > 0""",
    "text_index_words": """
        with words as (
          select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from documents
        ), places as (
          select doc_id, unnest(w) as term, generate_subscripts(w, 1) - 1 as place from words
        )
        select term, count(distinct doc_id) as n_docs, count(*) as n,
               cast(min(place) as int) as first_place, cast(max(place) as int) as last_place
        from places group by term""",
    "submissions_with_blocks": _with(
        ["v_blocks"],
        f"""select {_FILING}, file_number, page < last as older from v_blocks
            where page = last or (page % 5 <> 4 and page % 7 <> 3)""",
    ),
    "submission_blocks_report": _with(
        ["v_blocks"],
        """select distinct case when page % 5 = 4 then cik end as cik,
             'CIK' || cik || '-submissions-' || lpad(cast(page as varchar), 6, '0') || '.json' as block,
             case when page % 5 = 4 then 'named and missing' else 'present and not named' end as reason
           from v_blocks where page < last and (page % 5 = 4) <> (page % 7 = 3)""",
    ),
    "unknown_forms": _with(
        ["v_filings"],
        """select root_form as form_type, count(*) as n_filings from v_filings
           where root_form not in ('10-K', '10-Q') group by 1""",
    ),
    "unknown_forms_nearest": """
        with known as (
          select distinct unnest([p_brand, p_type]) as name from part
        ), named as (
          select p_partkey as k, case p_partkey % 2 when 0 then p_brand else p_type end as n,
                 cast(p_partkey % 5 + 2 as int) as cut
          from part
        ), written as (
          select case k % 4 when 0 then substr(n, 1, cut) || substr(n, cut + 2)
                   when 1 then substr(n, 1, cut) || 'x' || substr(n, cut + 1)
                   when 2 then lower(n) else 'zz-' || n end as form_type
          from named
        ), unknown as (
          select form_type, count(*) as n_filings from written
          where form_type not in (select name from known) group by 1
        ), pairs as (
          select form_type, name, levenshtein(upper(form_type), upper(name)) as d from unknown, known
        )
        select u.form_type, n_filings, arg_min(name, row(d, name)) filter (d <= 2) as nearest,
               cast(min(d) filter (d <= 2) as int) as distance
        from unknown u join pairs p on p.form_type = u.form_type group by all""",
    "preferred_type_default": _with(
        ["v_filings"],
        """select accession_number, root_form,
                  case when right(cik, 1) = '1' then 'txt'
                       when root_form in ('10-K', '10-Q') then 'xbrl' else 'htm' end
                    as preferred_type,
                  case when file_type in ('10-K', '10-Q') then 'xbrl' else 'htm' end
                    as unmapped_type,
                  file_type like '%/A' as amendment
           from v_filings""",
    ),
    "url_plan": _with(
        ["v_plan"],
        """select cik, accession_number, main_file_name, preferred_type, file_url, fallback_url,
                  false as skip from v_plan""",
    ),
    "url_plan_skip": _with(
        ["v_plan"],
        """select cik, accession_number, main_file_name, pref as preferred_type, url as file_url,
                  fallback_url, url is null as skip
           from (select *, base_url || '/' || case
                     when pref = 'xbrl' then accession_number || '-xbrl.zip'
                     when pref = 'txt' then 'd' || cast(order_no as varchar) || '.txt'
                     when suffix in ('htm', 'html') then main_file_name end as url
                 from (select *, case when right(cik, 1) = '3' then 'txt'
                                      when right(cik, 1) = '4' then 'html'
                                      else preferred_type end as pref from v_plan))""",
    ),
    "accession_urls": _with(
        ["v_filings"],
        """select cik, accession_number, base_url, base_url || '/' || main_file_name as file_url
           from v_filings""",
    ),
    "url_plan_to_fetch": _with(
        ["v_filings"],
        """select cik, accession_number, base_url || '/' || main_file_name as file_url
           from v_filings where suffix in ('htm', 'html')""",
    ),
    "fetch_with_fallback": _with(
        ["v_plan", "v_number"],
        """select accession_number, url as fetched_url,
                  regexp_replace(url, '^.*/', '') as save_name, url <> file_url as used_fallback
           from (select *, case when number % 11 = 0 then null
                     when file_url like '%.zip' and number % 7 = 0 then fallback_url
                     else file_url end as url
                 from v_plan join v_number using (order_no))""",
    ),
    "fetch_no_fallback": _with(
        ["v_plan", "v_number"],
        """select accession_number, url as fetched_url,
                  regexp_replace(url, '^.*/', '') as save_name,
                  case when url is not null then false end as used_fallback
           from (select *, case when number % 11 = 0 then null
                     when file_url like '%.zip' and number % 7 = 0 then null
                     else file_url end as url
                 from v_plan join v_number using (order_no)
                 where preferred_type = 'xbrl' or suffix in ('htm', 'html'))""",
    ),
    "fetch_summary": _with(
        ["v_filings", "v_number"],
        """select cik, file_type as form_type,
                  count(*) filter (where number % 11 <> 0) as n_files,
                  count(*) filter (where number % 11 = 0) as n_missing
           from v_filings join v_number using (order_no) group by 1, 2""",
    ),
    "ticker_map_last_wins": _with(["v_tickers"], "select ticker, cik from v_tickers"),
    "ticker_exchange_table": """
        select lpad(cast(s_suppkey as varchar), 10, '0') as cik, s_name as name,
               'T' || cast(s_suppkey as varchar) as ticker,
               case s_suppkey % 3 when 0 then 'Nasdaq' when 1 then 'NYSE' else 'OTC' end
                 as exchange
        from supplier""",
    "ticker_to_cik": _with(["v_resolved"], "select q_id, ticker_or_cik, cik from v_resolved"),
    "unresolved_tickers": _with(
        ["v_resolved"], "select q_id, ticker_or_cik from v_resolved where cik is null"
    ),
    "xbrl_urls": _with(
        ["v_resolved"],
        """select q_id,
                  'https://data.sec.gov/api/xbrl/companyfacts/CIK' || cik || '.json' as facts_url,
                  'https://data.sec.gov/api/xbrl/companyconcept/CIK' || cik
                    || '/us-gaap/AccountsPayableCurrent.json' as concept_url
           from v_resolved where cik is not null""",
    ),
    "index_rows": _with(
        ["v_filings"],
        """select cik, root_form as form_type, unnest(numbers) as file_number,
                  cik || '/' || root_form || '/' || accession_number || '/' || main_file_name
                    as file_path, filing_date
           from (select *, case when order_no % 6 = 0
                   then [file_number, '333-' || lpad(cast(order_no % 11 as varchar), 5, '0')]
                   else [file_number] end as numbers from v_filings)""",
    ),
    "index_by_form": _with(
        ["v_index"],
        """select cik, form_type, file_number, '/data/filings/' || file_path as file_path,
                  filing_date, accession_number
           from v_index where form_type = 'S-1.A'""",
    ),
    "index_by_cik": _with(
        ["v_index"],
        """select cik, form_type, file_number, '/data/filings/' || file_path as file_path,
                  filing_date, accession_number
           from v_index where cik in (select lpad(cast(c_custkey as varchar), 10, '0')
                                      from customer where c_mktsegment = 'MACHINERY')""",
    ),
    "file_number_groups": _with(
        ["v_index"],
        """select cik, file_number, count(*) as n_entries,
                  count(distinct form_type) as n_forms,
                  min(filing_date) as first_date, max(filing_date) as last_date
           from v_index group by 1, 2""",
    ),
    "file_number_lists": _with(
        ["v_index"],
        """select cik, file_number, substr(filing_date, 1, 7) as month, count(*) as n_entries,
                  string_agg(filing_date || ';' || file_path, '|'
                    order by filing_date, file_path) as entries
           from v_index group by 1, 2, 3""",
    ),
    "file_number_round_trip": _with(["v_index"], f"select {_ALL_INDEX} from v_index"),
    "index_compacted": _with(["v_index"], f"select {_ALL_INDEX} from v_index"),
    "index_import_append": _with(
        ["v_index"],
        """select cik, form_type, case when cast(accession_number as bigint) % 13 <> 5
                    then file_number end as file_number, file_path, filing_date
           from v_index""",
    ),
    "sibling_filings_blank": _with(
        ["v_index"],
        """select file_path, file_number,
                  count(*) over (partition by cik, file_number) - 1 as n_related
           from v_index where cast(accession_number as bigint) % 13 <> 5""",
    ),
    "file_number_import": _with(["v_index"], f"select {_ALL_INDEX} from v_index"),
    "related_filings": _with(
        ["v_index"],
        f"""select {_ALL_INDEX} from v_index
            where (cik, file_number) in (
              select (cik, file_number) from v_index where form_type = 'S-1.A')""",
    ),
    "sibling_filings": _with(
        ["v_index"],
        """select file_path, file_number, count(*) over g - 1 as n_related,
                  min(filing_date) over g as first_date, max(filing_date) over g as last_date
           from v_index window g as (partition by cik, file_number)""",
    ),
    "index_check_kept": _with(
        ["v_index", "v_present"],
        f"""select {_ALL_INDEX} from v_index
            where file_path in (select file_path from v_present)""",
    ),
    "index_check_removed": _with(
        ["v_index", "v_present"],
        f"""select {_ALL_INDEX} from v_index
            where file_path not in (select file_path from v_present)""",
    ),
    "index_check_report": _with(
        ["v_index_dup", "v_present"],
        """select cik, cast(sum(copies) as bigint) as entries,
                  cast(sum(copies - kept - missing) as bigint) as duplicates_removed,
                  cast(sum(missing) as bigint) as missing_removed,
                  cast(sum(kept) as bigint) as entries_kept,
                  count(*) filter (where kept = 0) as file_numbers_dropped
           from (select cik, file_number, count(*) as copies,
                        count(distinct p.file_path) as kept,
                        count(distinct i.file_path) - count(distinct p.file_path) as missing
                 from v_index_dup i left join v_present p on i.file_path = p.file_path
                 group by 1, 2)
           group by 1""",
    ),
    "index_check_rewrite": _with(
        ["v_index", "v_present"],
        f"""select {_ALL_INDEX} from v_index
            where file_path in (select file_path from v_present)""",
    ),
    "index_check_in_place": _with(
        ["v_index_years"],
        f"""select {_ALL_INDEX}, substr(filing_date, 1, 4) = '1995' as rewritten from v_index_years
            where not (substr(filing_date, 1, 4) = '1995' and n % 3 = 0)""",
    ),
    "manifest_difference": _with(
        ["v_index_years"],
        """select file_path,
             case when n % 17 = 0 then 'added' when n % 11 = 0 then 'removed' else 'changed' end
               as change,
             case when n % 17 <> 0 then 1000 + n % 700 end as old_length,
             case when n % 11 <> 0 then 1000 + n % 700 + cast(n % 13 = 0 as bigint) end
               as new_length,
             case when n % 17 <> 0 then filing_date || ' 00:00:00' end as old_modified,
             case when n % 11 <> 0 then
               cast(cast(filing_date as date) + cast(n % 19 = 0 as int) as varchar) || ' 00:00:00'
             end as new_modified
           from v_index_years
           where not (n % 17 = 0 and n % 11 = 0)
             and (n % 17 = 0 or n % 11 = 0 or n % 13 = 0 or n % 19 = 0)""",
    ),
    "index_check_changes": _with(
        ["v_index_years"], f"select {_ALL_INDEX} from v_index_years where n % 11 <> 0"
    ),
    "index_new_only": _with(
        ["v_index"], f"select {_ALL_INDEX} from v_index where filing_date >= '1999-01-01'"
    ),
    "index_append": _with(["v_index"], f"select {_ALL_INDEX} from v_index"),
    "index_csv_import": _with(["v_index"], f"select {_ALL_INDEX} from v_index"),
    "page_links": """
        select page_id, cast(n - 1 as int) as link_no, 'a' as tag, addresses[n] as address,
               regexp_extract(url, '^[a-z]+://[^/]*') || addresses[n] as url
        from (select page_id, url, addresses, unnest(range(1, len(addresses) + 1)) as n
              from (select page_id, url,
                           regexp_extract_all(html, '<a href="([^"]*)"', 1) as addresses
                    from pages))""",
    "page_rewrite": """
        select page_id,
               replace(html, '<a href="/', '<a href="' || regexp_extract(url, '^[a-z]+://[^/]*')
                 || '/') as html
        from pages""",
    "document_store": """
        select lpad(cast(page_id % 50 as varchar), 10, '0') || '/8-K.A/'
                 || lpad(cast(page_id as varchar), 18, '0')
                 || case page_id % 2 when 0 then '/main.htm' else '/main.txt' end as file_path,
               lpad(cast(page_id % 50 as varchar), 10, '0') as cik, '8-K/A' as form_type,
               lpad(cast(page_id as varchar), 18, '0') as accession_number,
               md5(content) as content_md5, strlen(content) as content_length
        from (select page_id, case page_id % 2 when 0 then
                 replace(html, '<a href="/', '<a href="'
                   || regexp_extract(url, '^[a-z]+://[^/]*') || '/')
                 else html end as content
              from pages)""",
    "facts_long": """
        select lpad(cast(l_suppkey as varchar), 10, '0') as cik, f.taxonomy, f.tag, f.unit,
               cast(cast(l_shipdate as date) as varchar) as "end",
               lpad(cast(l_orderkey as varchar), 18, '0') as accn,
               year(l_shipdate) as fy, 'Q' || cast(quarter(l_shipdate) as varchar) as fp,
               case l_returnflag when 'R' then '10-K' else '10-Q' end as form, f.val
        from (select *, unnest([
                {'taxonomy': 'us-gaap', 'tag': 'Revenues', 'unit': 'USD',
                 'val': l_extendedprice},
                {'taxonomy': 'us-gaap', 'tag': 'Revenues', 'unit': 'USD',
                 'val': l_extendedprice * 2},
                {'taxonomy': 'us-gaap', 'tag': 'UnitsSold', 'unit': 'shares',
                 'val': l_quantity},
                {'taxonomy': 'dei', 'tag': 'Rates', 'unit': 'pure', 'val': l_discount},
                {'taxonomy': 'dei', 'tag': 'Rates', 'unit': 'USD', 'val': l_tax},
                {'taxonomy': 'dei', 'tag': 'Shares', 'unit': 'pure', 'val': l_extendedprice / 7},
                {'taxonomy': 'dei', 'tag': 'Shares', 'unit': 'pure',
                 'val': l_quantity / 1e10}]) as f
              from lineitem)""",
    "company_concept": """
        select lpad(cast(l_suppkey as varchar), 10, '0') as cik, 'us-gaap' as taxonomy,
               'Revenues' as tag, 'USD' as unit,
               cast(cast(l_shipdate as date) as varchar) as "end",
               lpad(cast(l_orderkey as varchar), 18, '0') as accn,
               year(l_shipdate) as fy, 'Q' || cast(quarter(l_shipdate) as varchar) as fp,
               case l_returnflag when 'R' then '10-K' else '10-Q' end as form,
               l_extendedprice * m.factor as val
        from lineitem cross join (select unnest([1, 2]) as factor) m""",
    "facts_written": """
        select lpad(cast(l_suppkey as varchar), 10, '0') as cik, 'dei' as taxonomy,
               'Shares' as tag, 'pure' as unit,
               cast(cast(l_shipdate as date) as varchar) as "end",
               lpad(cast(l_orderkey as varchar), 18, '0') as accn,
               year(l_shipdate) as fy, 'Q' || cast(quarter(l_shipdate) as varchar) as fp,
               case l_returnflag when 'R' then '10-K' else '10-Q' end as form, val
        from (select *, unnest([l_extendedprice / 7, l_quantity / 1e10]) as val from lineitem)""",
    "facts_rejects": """
        select l_suppkey as key, case l_suppkey % 4 when 0 then 'no company key'
                 when 1 then 'no facts' else 'not a facts document' end as reason, count(*) as n
        from lineitem where l_suppkey % 4 <> 3 group by 1, 2""",
    "zip_members": """
        select cast(page_id // 20 as varchar) || '.zip' as archive,
               cast(page_id as varchar) || m.member as member, cast(0 as int) as part,
               strlen(m.content) as length, md5(m.content) as content_md5
        from (select page_id, unnest([
                {'member': '/main.htm', 'content': html},
                {'member': '/url.txt', 'content': url}]) as m
              from pages)""",
    "zip_files": """
        select cast(page_id // 20 as varchar) || '.zip' as archive,
               2 * count(*) as n_members,
               cast(sum(strlen(html) + strlen(url)) as bigint) as length
        from pages group by 1""",
    "archive_source": """
        select cast(page_id // 20 as varchar) || '.zip' as archive, 2 * count(*) as n_members,
               cast(sum(strlen(html) + strlen(url)) as bigint) as length
        from pages group by 1""",
    "archive_stream": """
        select cast(page_id // 20 as varchar) || '.zip' as archive, 2 * count(*) as n_members,
               cast(sum(strlen(html) + strlen(url)) as bigint) as length
        from pages group by 1""",
    "archive_listing": """
        select distinct cast(page_id // 20 as varchar) || '.zip' as archive, true as filled
        from pages""",
    "archive_rejects": """
        select cast(page_id // 20 as varchar) || '.zip' as archive,
               cast(page_id as varchar) || m as member, cast(null as varchar) as cik
        from (select page_id, unnest(['/main.htm', '/url.txt']) as m from pages)""",
    "submissions_from_archives": _with(
        ["v_filings"], f"select {_FILING}, file_number from v_filings"
    ),
    "document_members": """
        select folder || member as file_path, cik, form_type, accession_number, member,
               md5(content) as content_md5, strlen(content) as content_length
        from (select *, cik || '/' || form_type || '/' || accession_number || '/' as folder,
                     cast(page_id as varchar) || m.name as member, m.content as content
              from (select *, unnest([{'name': '/main.htm', 'content': html},
                                      {'name': '/url.txt', 'content': url}]) as m
                    from (select lpad(cast(page_id // 20 % 50 as varchar), 10, '0') as cik,
                                 '10-K' as form_type, page_id, html, url,
                                 lpad(cast(page_id // 20 as varchar), 18, '0')
                                   as accession_number from pages)))""",
    "links_left_alone": """
        select page_id, replace(html, '<a href="/', '<a href="' || case page_id % 4
                 when 0 then 'mailto:a@b.example/' when 1 then '#'
                 when 2 then regexp_extract(url, '^[a-z]+:') || '//other.example/'
                 else regexp_extract(url, '^[a-z]+://[^/]*') || '/' end) as html
        from pages""",
    "document_store_twice": """
        select lpad(cast(page_id % 50 as varchar), 10, '0') || '/8-K/'
                 || lpad(cast(page_id as varchar), 18, '0') || '/main.txt' as file_path,
               md5(content) as content_md5, strlen(content) as content_length
        from (select page_id, case page_id % 3 when 0 then 'new ' else '' end || html as content
              from pages)""",
    "ticker_map_written": _with(["v_tickers"], "select ticker, cik from v_tickers"),
    "thirteen_f_urls": """
        select distinct cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
               case when year(d) > 2021 or (year(d) = 2021 and quarter(d) >= 2)
                    then 'https://www.sec.gov/files/investment'
                    else 'https://www.sec.gov/divisions/investment/13f' end
                 || '/13flist' || cast(year(d) as varchar) || 'q'
                 || cast(quarter(d) as varchar) || '.pdf' as url
        from (select cast(o_orderdate as date) as d from orders union all
              select cast(o_orderdate + interval 264 months as date) from orders)""",
    "thirteen_f_rows": """
        select p_partkey // 40 as table_id, p_partkey % 40 as row_no, code || '|' || p_brand
                 || '|' || p_type as cells, code as cusip, p_brand as issuer,
               p_type as description
        from (select *, lpad(cast(p_partkey as varchar), 9, '0') as code from part)""",
    "security_csv_written": """
        select lpad(cast(p_partkey as varchar), 9, '0') as cusip, p_brand as issuer,
               p_type as description from part""",
    "identifier_scalars": """
        select o_orderkey,
               case o_orderkey % 4
                 when 0 then case when length(k) < 10 then lpad(k, 10, '0') else k end
                 when 1 then k || '12345678901' end as cik,
               acc as accession_number,
               regexp_replace(name, '^.*/', '') as file_name,
               case o_orderkey % 5 when 0 then 'htm' when 3 then 'gz' else '' end as suffix,
               acc as path_accession,
               '0000000001/' || o_orderstatus || '/' || acc || '/' || name as path
        from (select *, cast(o_orderkey as varchar) as k,
                     '000000000120' || lpad(cast(o_orderkey as varchar), 6, '0') as acc,
                     case o_orderkey % 5
                       when 0 then 'htm' || cast(o_orderkey as varchar) || '.htm'
                       when 1 then '.hidden'
                       when 2 then 'a.b/' || cast(o_orderkey as varchar)
                       when 3 then 'xsl/x' || cast(o_orderkey as varchar) || '.tar.gz'
                       else '' end as name
              from orders)""",
    "retrieve_filings": _with(
        ["v_asked", "v_number"],
        """select request_cik, request_form, request_after, request_before,
                  cik, root_form as form_type, accession_number,
                  url as fetched_url, regexp_replace(url, '^.*/', '') as save_name,
                  url <> file_url as used_fallback, filing_date
           from (select *, case when number % 11 = 0 then null
                     when number % 7 = 0 then base_url || '/' || main_file_name
                     else file_url end as url
                 from (select *, base_url || '/' || accession_number || '-xbrl.zip' as file_url,
                              row_number() over (partition by request_cik, request_form,
                                  request_after, request_before
                                order by filing_date desc, accession_number desc) as rn
                       from v_asked) join v_number using (order_no)
                 where rn <= 3)""",
    ),
    "retrieve_open_dates": _with(
        ["v_asked"],
        """select request_cik, request_form, request_after, request_before, count(*) as n,
                  min(filing_date) as first_date
           from (select *, row_number() over (partition by request_cik, request_form,
                            request_after, request_before
                          order by filing_date desc, accession_number desc) as rn from v_asked)
           where rn <= 1001 group by 1, 2, 3, 4""",
    ),
    "request_rejects": _with(
        ["v_resolved"],
        """select distinct ticker_or_cik, case when q_id % 3 = 0 then '10-Q' else '10-K' end
                    as form_type,
                  case when q_id % 4 >= 2 then '1996-01-01' end as after_date,
                  case when q_id % 4 >= 2 then '1999-12-31' end as before_date
           from v_resolved where cik is null""",
    ),
    "retrieve_to_store": _with(
        ["v_asked", "v_number"],
        """select distinct path as file_path, cik, form_type, unnest(numbers) as file_number,
                  md5('<p>' || base_url || '/' || main_file_name || '</p><a href="'
                    || case when suffix in ('htm', 'html') then base_url || '/' else '' end
                    || 'ex1.htm">exhibit</a>') as content_md5
           from (select *, root_form as form_type,
                        cik || '/' || root_form || '/' || accession_number || '/'
                          || main_file_name as path,
                        case when order_no % 6 = 0
                          then [file_number, '333-' || lpad(cast(order_no % 11 as varchar), 5, '0')]
                          else [file_number] end as numbers
                 from (select *, row_number() over (partition by request_cik, request_form,
                                  request_after, request_before
                                order by filing_date desc, accession_number desc) as rn
                       from v_asked
                       where contains(accession_number || ':' || main_file_name, '0:d')
                         and contains(accession_number || ':' || main_file_name, '1'))
                 join v_number using (order_no)
                 where rn <= 3 and number % 11 <> 0
                   and not (right(cik, 1) = '1' and file_type = root_form))""",
    ),
    "watch_to_index": _with(
        ["v_filings", "v_index"],
        """select i.cik, i.form_type, i.file_number, i.file_path, i.filing_date,
                  length('<p>' || f.base_url || '/' || f.main_file_name || '</p><a href="'
                    || case when f.suffix in ('htm', 'html') then f.base_url || '/' else '' end
                    || 'ex1.htm">exhibit</a>') as content_length
           from v_index i join v_filings f on i.accession_number = f.accession_number
           where i.filing_date >= '2000-06-01' and f.file_type in ('S-1', 'S-1/A')
             and i.file_number not in ('001-00000', '001-00003')""",
    ),
    "retrieve_to_index": _with(
        ["v_asked", "v_number"],
        """select distinct cik, root_form as form_type, unnest(numbers) as file_number,
                  cik || '/' || root_form || '/' || accession_number || '/' || accession_number
                    || '-xbrl.zip' as file_path, filing_date
           from (select *, case when order_no % 6 = 0
                   then [file_number, '333-' || lpad(cast(order_no % 11 as varchar), 5, '0')]
                   else [file_number] end as numbers
                 from (select *, row_number() over (partition by request_cik, request_form,
                                  request_after, request_before
                                order by filing_date desc, accession_number desc) as rn
                       from v_asked where file_type not like '%/A')
                 join v_number using (order_no)
                 where rn <= 3 and number % 11 <> 0 and number % 7 <> 0)""",
    ),
    "filing_hook": _with(
        ["v_filings"],
        """select accession_number, lower(file_type) || '@' || filing_date as label
           from v_filings""",
    ),
    "watch_new_filings": _with(
        ["v_filings", "v_index"],
        """select i.cik, i.form_type, i.file_number, i.file_path, i.filing_date,
                  f.base_url || '/' || f.main_file_name as file_url
           from v_index i join v_filings f on i.accession_number = f.accession_number
           where i.filing_date >= '2000-06-01' and f.file_type in ('S-1', 'S-1/A')
             and i.file_number not in ('001-00000', '001-00003')""",
    ),
    "stream_index": _with(["v_index"], f"select {_ALL_INDEX} from v_index"),
    "stream_rejects": _with(
        ["v_filings"],
        """select cik, case when right(cik, 1) = '3' then 'rejected' else 'indexed' end as kind,
                  case when right(cik, 1) = '3' then count(distinct order_no // 65536)
                       else count(*) end as n
           from v_filings group by 1, 2""",
    ),
    "stream_feed_keyed": _with(["v_filings"], f"select {_FILING} from v_filings"),
    "filing_callback": """
        select lpad(cast(page_id % 50 as varchar), 10, '0') || '/8-K/'
                 || lpad(cast(page_id as varchar), 18, '0') || '/main.txt' as file_path,
               strlen(url) as length, strlen(url) as again
        from pages""",
    "stream_new_filings": _with(["v_filings"], f"select {_FILING} from v_filings"),
}
