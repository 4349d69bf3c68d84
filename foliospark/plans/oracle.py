"""SQL twins of the catalog's queries, for DuckDB over the same tables.

They restate what each query means in plain SQL and share nothing with the
Spark code but the fixed values.
"""

from __future__ import annotations

import json

from foliospark import constants as K
from foliospark.contract import Contract
from foliospark.plans.catalog import SEARCH_WORDS, STOP_WORDS, SWEEP_KS, TODAY

ORACLE: dict[str, str] = {}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- text fragments --------------------------------------------------------

def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{K.WS}]+|[{K.WS}]+$', '', 'g')"


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{K.WS}]+'))"


def bold(x: str) -> str:
    return rf"regexp_replace(coalesce({x}, ''), '\*\*(.+?)\*\*', '\1', 'g')"


def italics(x: str) -> str:
    # Runs of stars are hidden first, so that only single stars are left.
    hidden = f"replace(replace({x}, '**', chr(1) || chr(1)), chr(1) || '*', chr(1) || chr(1))"
    return rf"replace(regexp_replace({hidden}, '\*([^*\n]+)\*', '\1', 'g'), chr(1), '*')"


def tidy(x: str) -> str:
    links = rf"regexp_replace({x}, '\[([^\]]+)\]\([^)]+\)', '\1', 'g')"
    blanks = rf"regexp_replace({links}, '[ \t]+', ' ', 'g')"
    return strip(rf"regexp_replace({blanks}, '\n{{3,}}', chr(10) || chr(10), 'g')")


def clean(x: str) -> str:
    return tidy(italics(bold(x)))


def month_date(x: str) -> str:
    hit = f"regexp_extract({x}, '{K.MONTH_DATE}', 0)"
    part = [f"regexp_extract({hit}, '{K.MONTH_DATE}', {g})" for g in (1, 2, 3)]
    return f"cast(cast(try_strptime(concat_ws(' ', {', '.join(part)}), '%B %d %Y') as date) as varchar)"


def approved(x: str) -> str:
    hit = f"regexp_extract({x}, '{K.APPROVED_LINE}', 0)"
    return month_date(f"regexp_replace({hit}, '(?i)^approved', '')")


def normalize(x: str) -> str:
    out = f"lower(translate({x}, {lit(K.NORMALIZE_FROM)}, {lit(K.NORMALIZE_TO)}))"
    for pattern in [*K.NORMALIZE_PATTERNS, K.NORMALIZE_LINE]:
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return f"trim(regexp_replace({out}, '[{K.WS}]+', ' ', 'g'))"


# --- derived inputs --------------------------------------------------------

ACTS = r"""
keyed as (
  select *, cast(doc_id - case when doc_id % 40 = 39 then 1 else 0 end as varchar) as no,
         1946 + doc_id % 80 as yr,
         cast(date '1946-01-01' + cast((doc_id * 7) % 28000 as integer) as date) as d
  from documents),
acts as (
  select doc_id, no, yr, d,
    case when doc_id % 50 = 49 then concat('ra', yr)
         when doc_id % 50 = 48 then concat('notes_', doc_id)
         else concat('ra_', no, '_', yr) end as basename,
    case when doc_id % 45 = 44 then '' else
      concat('**Republic Act No. ', no, '** ', strftime(d, '%B %-d, %Y'), chr(10), chr(10),
             '**An Act Number ', no, ' concerning ', source, ' matters**', chr(10), chr(10),
             '**Section 1.** ', text,
             case when doc_id % 3 <> 0 then concat(chr(10), chr(10), 'Approved: ', strftime(d, '%B %-d, %Y'))
                  else '' end) end as content,
    concat('docs/', lang, '/', doc_id, '.md') as path
  from keyed)"""

HEADED = ACTS + rf""",
lined as (select *, regexp_split_to_array(content, '{K.LINE_BREAK}') as lines from acts),
located as (
  select *, coalesce(list_position(list_transform(lines,
      lambda l: regexp_matches(l, '{K.HEADER_LINE}')), true), 0) as hpos from lined),
headed as (
  select *, case when hpos > 0 then lines[hpos] end as hline from located),
parts as (
  select *, nullif(regexp_extract(hline, '{K.HEADER_LINE}', 1), '') as hnumber,
    {month_date(f"regexp_extract(hline, '{K.HEADER_LINE}', 2)")} as hdate,
    list_filter(list_transform(lines[hpos + 1:], lambda l: {clean(strip('l'))}),
      lambda s: length(s) >= {K.TITLE_MIN_CHARS}
        and not regexp_matches(lower(s), '{K.TITLE_SKIP}')
        and not regexp_matches(s, '^{K.MONTH_DATE}$'))[1] as title,
    {clean(strip("coalesce(array_to_string(lines[hpos + 1:], chr(10)), '')"))} as body,
    {approved('content')} as approved_line
  from headed)"""

# Staged rows of all acts; `doc_id` stays for the choice of sources.
STAGED = HEADED + f""",
named as (
  select *, coalesce(nullif(regexp_extract(basename, '{K.BASENAME}', 1), ''), hnumber) as ra_number,
    coalesce(try_cast(regexp_extract(basename, '{K.BASENAME}', 2) as bigint),
             try_cast(substr(hdate, 1, 4) as bigint)) as ra_year
  from parts where not coalesce(regexp_matches(basename, '{K.INDEX_BASENAME}'), false)),
staged as (
  select doc_id, 'RA-' || ra_number as ra_id, ra_number, ra_year,
    coalesce(title, 'Republic Act No. ' || ra_number) as title,
    coalesce(approved_line, hdate) as approval_date,
    body as content_clean, length(body) as content_length, {words('body')} as word_count,
    '{K.SOURCE_MARKDOWN}' as source, path as source_path
  from named where ra_number is not null and ra_year is not null),
primary_rows as (select * exclude (doc_id) from staged where doc_id % 10 >= 2),
secondary_rows as (
  select * exclude (doc_id) replace ('{K.SOURCE_HTML}' as source) from staged where doc_id % 10 < 4)"""

UNCLEAN = STAGED + f""",
unclean as (select *, {normalize('content_clean')} as content_normalized from staged)"""

ENTRIES = f"""
raw_entries as (
  select doc_id, doc_id // 50 as page, row_number() over (partition by doc_id // 50 order by doc_id) - 1 as pos,
    case when doc_id % 89 = 88 then -1 when doc_id % 97 = 96 then 2 else 3 end as entry_size,
    concat(case when doc_id % 5 = 0 then 'IRR of ' else '' end, 'REPUBLIC ACT NO. ',
           doc_id - case when doc_id % 40 = 39 then 1 else 0 end) as label,
    case when doc_id % 9 = 0 then ''
         else cast(cast(date '1946-01-01' + cast((doc_id * 7) % 28000 as integer) as date) as varchar) end as day,
    concat('<a href=''https://{K.INDEX_HOST}/thebookshelf/showdocs/2/', doc_id, '''>', text, '</a>')
      as link
  from documents),
entries as (
  select doc_id, page, pos, cast(entry_size as integer) as entry_size,
    case when entry_size > 0 then label end as title, case when entry_size > 0 then day end as date_text,
    case when entry_size > 2 then link end as anchor
  from raw_entries),
good_entries as (select * from entries where entry_size >= 3)"""

_INNER = f"trim(regexp_replace(regexp_extract(anchor, '{K.ANCHOR_INNER}', 1), '[{K.WS}]+', ' ', 'g'))"
_TITLE = f"case when length({_INNER}) >= {K.TITLE_MIN_CHARS} then {_INNER} else title end"
_LABEL = f"nullif(regexp_extract(title, '{K.LABEL}', 1), '')"

INDEX = ENTRIES + f""",
index_shaped as (
  select page, pos, {_LABEL} as ra_number, nullif(date_text, '') as approval_date, {_TITLE} as title,
    concat('thebookshelf/showdocs/2/', doc_id) as source_path from good_entries),
index_rows as (
  select 'RA-' || ra_number as ra_id, ra_number, cast(substr(approval_date, 1, 4) as bigint) as ra_year, title,
    approval_date, title as content_clean, length(title) as content_length, {words('title')} as word_count,
    '{K.SOURCE_JSON}' as source, source_path
  from index_shaped where ra_number is not null
  qualify row_number() over (partition by ra_number order by page, pos) = 1)"""

MANIFEST = """
manifest as (
  select page_id, url, concat('ra', page_id % 50, '/', case when page_id % 7 = 0 then 'IRR_' else 'ra_' end,
    page_id, '_', 1950 + page_id % 70, '.html') as source_path from pages),
landed as (select replace(source_path, '/', '__') as slug, html from manifest join pages using (page_id)
           where page_id % 10 <> 3),
listed as (select m.page_id, m.source_path, replace(m.source_path, '/', '__') as slug, l.html
           from manifest m left join landed l on l.slug = replace(m.source_path, '/', '__'))"""

DATED_ORDERS = """
dated as (select o_orderkey, o_totalprice,
  case when o_orderkey % 20 <> 0 then year(o_orderdate) end as ra_year from orders)"""

FILLED = """
base as (select o_orderkey, case when o_orderkey % 3 <> 0 then cast(o_orderdate as date) end as day from orders),
lookup as (select l_orderkey, cast(l_shipdate as date) as fill from lineitem where l_shipdate is not null
  qualify row_number() over (partition by l_orderkey
    order by l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1),
filled as (select o_orderkey, coalesce(day, fill) as day, day is null and fill is not null as recovered
  from base left join lookup on l_orderkey = o_orderkey)"""

ISO_TEXTS = """
iso_texts as (select o_orderkey, concat('RA-', o_orderkey) as ra_id,
  case when o_orderkey % 11 = 0 then '2015-7-6' when o_orderkey % 13 = 0 then '2015-02-30'
       when o_orderkey % 17 = 0 then 'soon' when o_orderkey % 19 = 0 then null
       else strftime(o_orderdate, '%Y-%m-%d') end as approval_date from orders)"""

DOCS = f"""
docs as (select doc_id, text as content_clean, lang, source, length(text) as content_length,
  {words('text')} as word_count from documents)"""

LABELLED = "labelled as (select d.*, l.quality, l.toxic from documents d left join labels l using (doc_id))"


def with_(ctes: str, body: str) -> str:
    return f"with {ctes}\n{body}"


# --- scans, sources, sinks -------------------------------------------------

ORACLE["scan_parquet_projection"] = (
    "select doc_id, source, n_chars from documents where lang = 'en' and n_chars > 500"
)
ORACLE["json_tuple_explode"] = with_(
    ENTRIES, "select page, cast(pos as integer) as pos, entry_size, title, date_text, anchor from entries"
)
ORACLE["json_field_extract"] = (
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events"
)
ORACLE["pages_manifest_join"] = with_(
    MANIFEST, "select page_id, slug, html is not null as found, cast(strlen(html) as bigint) as n_bytes from listed"
)
ORACLE["partition_stats"] = with_(DATED_ORDERS, """
select count(distinct ra_year) as n_partitions, min(ra_year) as years_min, max(ra_year) as years_max,
  count(ra_year) as rows_written, count(*) filter (ra_year is null) as rows_excluded, count(ra_year) as rows_read,
  true as bytes_match from dated""")
ORACLE["partition_pruned_read"] = with_(DATED_ORDERS, """
select ra_year as year, count(*) as n, round(sum(o_totalprice), 2) as total from dated where ra_year = 1997
group by ra_year""")
ORACLE["planned_partitions"] = with_(
    DATED_ORDERS, "select distinct ra_year as year from dated where ra_year is not null order by year"
)
ORACLE["csv_roundtrip_hash"] = (
    "select doc_id, sha256(nullif(text, '')) as text_sha256, sha256(source) as source_sha256 from documents"
)
ORACLE["jsonl_roundtrip"] = with_(
    LABELLED, "select doc_id, lang, n_chars, quality, sha256(text) as text_sha256 from labelled"
)
ORACLE["format_comparison"] = """
select format, (select count(*) from documents) as rows, true as columns_match, true as rows_match
from (values ('parquet_single'), ('parquet_partitioned'), ('csv'), ('json_lines')) t(format)"""
ORACLE["upsert_merge"] = """
with target as (select * from customer where c_custkey % 3 <> 0),
source as (select * replace (c_acctbal + 1 as c_acctbal) from customer where c_custkey % 2 = 0 or c_custkey % 3 = 0)
select * replace (round(c_acctbal, 2) as c_acctbal), case when c_custkey in (select c_custkey from target) then 'updated' else 'inserted' end as action
from source
union all
select * replace (round(c_acctbal, 2) as c_acctbal), 'kept' as action from target
where c_custkey not in (select c_custkey from source)"""
ORACLE["upsert_counts"] = """
select case when c_custkey % 3 = 0 then 'inserted' when c_custkey % 2 = 0 then 'updated' else 'kept' end as action,
  count(*) as n from customer group by 1"""
ORACLE["upsert_bucketed"] = """
select c_custkey, round(case when c_custkey % 10 = 1 then c_acctbal + 1 else c_acctbal end, 2) as c_acctbal, true as others_kept
from customer where c_custkey % 3 <> 0 or c_custkey % 10 = 1"""
ORACLE["full_replace"] = "select c_custkey, round(c_acctbal, 2) as c_acctbal from customer"
ORACLE["published_artefacts"] = """
select artefact, doc_id, sha256(case when artefact = 'csv' then nullif(text, '') else text end) as text_sha256, true as refused
from documents, (values ('curated'), ('partitions'), ('csv'), ('jsonl')) t(artefact) where doc_id % 2 = 0"""
ORACLE["optional_source"] = """
with base as (select o_orderkey, o_orderkey % 3 = 0 or o_orderdate is null as gap from orders),
lookup as (select distinct l_orderkey from lineitem where l_linenumber = 1 and l_shipdate is not null),
told as (select gap, l_orderkey is not null as found from base left join lookup on l_orderkey = o_orderkey)
select 'there' as lookup, count(*) as n_rows, count(*) filter (gap and found) as recovered, count(*) filter (gap and not found) as nulls_after from told
union all select 'absent', count(*), 0, count(*) filter (gap) from told"""
ORACLE["load_prepare"] = with_(UNCLEAN, """
select ra_id, cast(ra_year as integer) as ra_year, cast(approval_date as date) as approval_date,
  cast(content_length as integer) as content_length, cast(word_count as integer) as word_count, source_path
from unclean""")
ORACLE["landing_pending"] = "select event_id, event_type from events where event_id % 3 <> 0"
ORACLE["landing_manifest"] = """
with paged as (select event_id // 500 as page from events)
select count(distinct page) filter (page % 4 <> 3) as pages, count(*) as records_total,
  count(*) filter (page % 4 <> 3) as records_fetched,
  count(distinct page) filter (page % 4 <> 3) = count(distinct page) as complete, false as sample from paged"""
ORACLE["seeded_sample"] = (
    "select page_id, url from pages order by md5(concat('42', page_id)), page_id limit 40"
)

# --- staging functions -----------------------------------------------------

ORACLE["basename_parse"] = with_(ACTS, f"""
select doc_id, nullif(regexp_extract(basename, '{K.BASENAME}', 1), '') as ra_number,
  try_cast(regexp_extract(basename, '{K.BASENAME}', 2) as bigint) as ra_year from acts""")
ORACLE["filter_index_rows"] = with_(
    ACTS, f"select doc_id, basename from acts where not regexp_matches(basename, '{K.INDEX_BASENAME}')"
)
ORACLE["header_extract"] = with_(
    HEADED, "select doc_id, hnumber as number, hdate as header_date, cast(hpos - 1 as bigint) as line_index from parts"
)
ORACLE["approval_date_extract"] = with_(
    HEADED, "select doc_id, approved_line, coalesce(approved_line, hdate) as approval_date from parts"
)
ORACLE["title_line"] = with_(HEADED, "select doc_id, title from parts")
ORACLE["body_extract"] = with_(HEADED, "select doc_id, body from parts")
ORACLE["clean_markdown"] = with_(ACTS, f"select doc_id, {clean('content')} as cleaned from acts")
ORACLE["clean_markdown_core"] = with_(ACTS, f"select doc_id, {tidy(bold('content'))} as cleaned from acts")
ORACLE["content_metrics"] = with_(DOCS, "select doc_id, content_length, word_count from docs")
ORACLE["parse_month_date"] = f"""
with days as (select o_orderkey, cast(date '1950-01-01' + cast(o_orderkey % 20000 as integer) as date) as d from orders),
texts as (select o_orderkey,
  case when o_orderkey % 4 = 0 then concat('Sept. ', strftime(d, '%-d, %Y'))
       when o_orderkey % 4 = 1 then concat('on ', upper(strftime(d, '%B %-d %Y')))
       when o_orderkey % 4 = 2 then concat('February ', o_orderkey % 32, ', 2001')
       else strftime(d, '%B %-d, %Y') end as date_text from days)
select o_orderkey, {month_date('date_text')} as parsed from texts"""
ORACLE["parse_dates_coerce"] = with_(ISO_TEXTS, """
select o_orderkey, cast(try_strptime(approval_date, '%Y-%m-%d') as date) as approval_date_dt from iso_texts""")
ORACLE["year_from_date"] = with_(
    ISO_TEXTS, "select o_orderkey, try_cast(substr(approval_date, 1, 4) as bigint) as year from iso_texts"
)
ORACLE["stage_markdown"] = with_(STAGED, "select * exclude (doc_id) from staged")
ORACLE["stage_index"] = with_(INDEX, "select * from index_rows")
ORACLE["normalize_content"] = with_(
    ACTS, f"select doc_id, {normalize('content')} as content_normalized from acts"
)
ORACLE["label_filter"] = with_(
    ENTRIES, f"select page, cast(pos as integer) as pos, {_LABEL} as ra_number from good_entries where {_LABEL} is not null"
)
ORACLE["anchor_title"] = with_(
    ENTRIES, f"select page, cast(pos as integer) as pos, {_TITLE} as title from good_entries"
)
ORACLE["anchor_path"] = with_(ENTRIES, """
select page, cast(pos as integer) as pos, concat('thebookshelf/showdocs/2/', doc_id) as source_path from good_entries""")
ORACLE["path_prefix_filter"] = with_(
    MANIFEST, "select page_id, source_path from manifest where source_path not ilike '%/irr\\_%' escape '\\'"
)
_HTML_TITLE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
ORACLE["html_title"] = f"""
select page_id, {_HTML_TITLE} as page_title,
  nullif(regexp_extract({_HTML_TITLE}, '{K.HTML_TITLE_NUMBER}', 1), '') as ra_number from pages"""
ORACLE["link_extract"] = """
with found as (select page_id, url as base,
    unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1)) as href,
    generate_subscripts(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1), 1) - 1 as pos
  from pages)
select page_id, cast(pos as integer) as pos, translate(trim(href), '"''“”‘’', '') as source_path,
  regexp_extract(base, '^[a-z]+://[^/?#]*', 0) || translate(trim(href), '"''“”‘’', '') as url from found"""

ORACLE["index_table_links"] = """
select concat('RA No. ', doc_id) as ra_label, concat('https://acts.example.org/index/ra', 1946 + doc_id % 80, '/ra_', doc_id, '.html') as url,
  strftime(cast(date '1950-01-01' + cast(doc_id % 20000 as integer) as date), '%B %-d, %Y') as date_text,
  concat('An act on ', source, ' & ', lang) as title, concat('ra', 1946 + doc_id % 80, '/ra_', doc_id, '.html') as source_path
from documents where doc_id % 23 <> 0 and doc_id % 17 <> 0 and doc_id % 19 <> 0"""

# The test pages hold p, b, br and h1 inside their article, and two entities.
def unescape(x: str) -> str:
    return f"""replace(replace(replace({x}, '&quot;', '"'), '&amp;', '&'), '&amp', '&')"""


def tag_text(x: str) -> str:
    pieces = f"list_transform(string_split(regexp_replace({x}, '<[^>]*>', chr(3), 'g'), chr(3)), lambda t: {strip(unescape('t'))})"
    return f"coalesce(array_to_string(list_filter({pieces}, lambda t: t <> ''), ' '), '')"


_CUT = "split_part(split_part(p, '</p>', 1), '<h1>', 1)"
PAGES = f"""
cut_pages as (
  select page_id, list_transform(string_split(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '<p>')[2:],
    lambda p: {_CUT}) as cuts, {unescape(_HTML_TITLE)} as page_title from pages),
parsed_pages as (
  select page_id, page_title, list_filter(list_transform(cuts, lambda p: {tag_text('p')}),
      lambda t: not regexp_matches(t, '^{K.HTML_TITLE_NUMBER}')
        and not (regexp_matches(t, '{K.ENACT_PARAGRAPH}') and length(t) < {K.ENACT_PARAGRAPH_MAX})) as paragraphs,
    list_filter(list_transform(list_filter(cuts, lambda p: contains(p, '<b>')),
        lambda p: {tag_text("split_part(p, '<b>', 2)")}),
      lambda t: length(t) > {K.TITLE_MIN_CHARS} and not regexp_matches(t, '^{K.HTML_TITLE_NUMBER}'))[1] as title
  from cut_pages)"""
ORACLE["html_meta_title"] = with_(PAGES, "select page_id, page_title, title from parsed_pages")
ORACLE["html_paragraphs"] = with_(PAGES, """
select page_id, cast(unnest(range(len(paragraphs))) as integer) as pos, unnest(paragraphs) as paragraph
from parsed_pages""")
_BODY = strip(
    r"regexp_replace(regexp_replace(coalesce(array_to_string(paragraphs, chr(10) || chr(10)), ''), '[ \t]+', ' ', 'g'), "
    r"'\n{3,}', chr(10) || chr(10), 'g')"
)
ORACLE["stage_html"] = with_(PAGES + "," + MANIFEST, f""",
numbered as (
  select m.page_id, m.source_path, coalesce(nullif(regexp_extract(page_title, '{K.HTML_TITLE_NUMBER}', 1), ''),
      cast(m.page_id as varchar)) as ra_number, title, {_BODY} as body,
    cast(cast(date '1950-01-01' + cast(m.page_id % 20000 as integer) as date) as varchar) as approval_date
  from manifest m join parsed_pages p on p.page_id = m.page_id
  where m.page_id % 10 <> 3 and m.page_id % 7 <> 0)
select 'RA-' || ra_number as ra_id, ra_number, 1950 + page_id % 70 as ra_year,
  coalesce(title, concat('Listed title ', page_id)) as title, approval_date, body as content_clean,
  length(body) as content_length, {words('body')} as word_count, '{K.SOURCE_HTML}' as source, source_path
from numbered""")

# --- reconcile -------------------------------------------------------------

ORACLE["drop_stubs"] = with_(DOCS, f"select doc_id, word_count from docs where word_count >= {K.MIN_WORD_COUNT}")
ORACLE["drop_empty_text"] = with_(ACTS, "select doc_id from acts where length(content) > 0")
ORACLE["dedupe_first"] = """
select doc_id, lang, source from documents qualify row_number() over (partition by text order by doc_id) = 1"""
ORACLE["duplicate_groups"] = "select doc_id from documents qualify count(*) over (partition by text) > 1"
ORACLE["duplicate_dropped"] = """
select doc_id from documents qualify row_number() over (partition by text order by doc_id) > 1"""
ORACLE["exclude_ids"] = """
select doc_id, source from documents where source not in ('src3', 'src7', 'no-such-source')"""
ORACLE["absent_ids"] = """
select source from (values ('src3'), ('src7'), ('no-such-source')) t(source)
where source not in (select source from documents)"""
ORACLE["oversized_rows"] = with_(
    DOCS, "select doc_id, content_length from docs where content_length > 3000 order by content_length desc, doc_id"
)
ORACLE["merge_primary_secondary"] = with_(STAGED, """
select ra_id, ra_year, source, source_path from primary_rows
union all
select ra_id, ra_year, source, source_path from secondary_rows
where ra_id not in (select ra_id from primary_rows)""")
ORACLE["source_overlap"] = with_(STAGED, """
select count(*) as n_secondary, count(*) filter (hit) as n_overlap, count(*) filter (not hit) as n_secondary_only,
  round(count(*) filter (hit) / count(*), 6) as overlap_share
from (select ra_id in (select ra_id from primary_rows) as hit from secondary_rows)""")
ORACLE["row_reconciliation"] = with_(STAGED, f""",
solid as (select * from primary_rows where word_count >= {K.MIN_WORD_COUNT})
select 'primary' as origin, 'stub' as fate, count(*) as n from primary_rows where not word_count >= {K.MIN_WORD_COUNT}
union all select 'primary', 'duplicate', count(*) - count(distinct ra_id) from solid
union all select 'primary', 'kept', count(distinct ra_id) from solid
union all select 'secondary', 'overlap', count(*) from secondary_rows where ra_id in (select ra_id from solid)
union all select 'secondary', 'kept', count(*) from secondary_rows where ra_id not in (select ra_id from solid)""")
ORACLE["curated_projection"] = with_(STAGED + "," + INDEX, f""",
kept as (select * from primary_rows where word_count >= {K.MIN_WORD_COUNT}
         qualify row_number() over (partition by ra_id order by source_path) = 1),
merged as (select * from kept union all by name
           select * from secondary_rows where ra_id not in (select ra_id from kept)),
dates as (select ra_number, approval_date as fill from index_rows where approval_date is not null)
select ra_id, m.ra_number, ra_year, title, coalesce(approval_date, fill) as approval_date, content_clean,
  {normalize('content_clean')} as content_normalized, content_length, word_count, source, source_path
from merged m left join dates d on d.ra_number = m.ra_number""")
ORACLE["curated_summary"] = with_(STAGED, """
select count(*) as n_rows, count(distinct ra_id) as distinct_ra_id, count(distinct ra_year) as distinct_years,
  min(ra_year) as year_min, max(ra_year) as year_max, count(*) filter (title is null) as null_title,
  count(*) filter (approval_date is null) as null_date from staged""")
ORACLE["source_distribution"] = "select source, count(*) as n from documents group by source"
ORACLE["gap_fill_date"] = with_(FILLED, "select * from filled")
ORACLE["gap_fill_audit"] = with_(FILLED, """
select *, case when nulls_before > 0 then round(100.0 * recovered / nulls_before::double, 4) else 0.0::double end as filled_pct,
  case when n_rows > 0 then round(100.0 * nulls_before / n_rows::double, 4) else 0.0::double end as null_pct_before,
  case when n_rows > 0 then round(100.0 * nulls_after / n_rows::double, 4) else 0.0::double end as null_pct_after
from (select count(*) as n_rows, count(*) filter (day is null or recovered) as nulls_before,
        count(*) filter (day is null) as nulls_after, count(*) filter (recovered) as recovered from filled)""")
ORACLE["weekday_share_by_origin"] = with_(FILLED, """
select case when recovered then 'recovered' else 'original' end as origin, isodow(day) - 1 as weekday, count(*) as n,
  round(count(*) / sum(count(*)) over (partition by recovered), 6) as share
from filled where day is not null group by recovered, isodow(day)""")

# --- contract checks -------------------------------------------------------


def verdict(name: str, source: str, bad: str, sample: str, ok: str, failed: str,
            severity: str = "error", per_value: bool = False, order: str = "v", shown: str = "v") -> str:
    """Result row of one rule: ``bad`` rows of ``source``, five smallest samples."""
    n = "count(distinct v)" if per_value else "count(*)"
    status = "warn" if severity == "warn" else "fail"
    return f"""
select '{name}' as check_name, '{severity}' as severity, case when n = 0 then 'pass' else '{status}' end as status,
  case when n = 0 then {lit(ok)} else {failed} end as message, n as violations,
  coalesce((select string_agg({shown}, '; ' order by {order}) from (
     select distinct {sample} as v from {source} where {bad} order by {order} limit 5)), '') as samples
from (select {n} as n from (select {sample} as v from {source} where {bad}))"""


_contract = Contract.parse()
_required = _contract.required()
_wanted = ", ".join(f"({at}, '{c.name}', '{c.kind.simpleString()}')" for at, c in enumerate(_contract.columns.values()))
# The found schema is what DuckDB says of the same projection.
_DRIFT = ACTS + f""",
drifted as (select path as source_path, cast(yr as integer) as ra_year, case when doc_id % 3 <> 0 then basename end as basename from acts),
found as (select row_number() over () as place, column_name as name,
    case column_type when 'VARCHAR' then 'string' when 'INTEGER' then 'int' when 'BIGINT' then 'bigint' end as found from (describe (from drifted))),
wanted as (select * from (values {_wanted}) t(place, name, expected)),
compared as (select coalesce(w.name, f.name) as name, expected, found, w.place as w_at, f.place as f_at,
    case when found is null then 'missing' when expected is null then 'unexpected' when expected <> found then 'type' end as problem
  from wanted w full join found f using (name))"""
ORACLE["schema_report"] = with_(_DRIFT, """
select name, expected, found, problem, case name when 'source_path' then (select count(source_path) from drifted)
    when 'ra_year' then (select count(ra_year) from drifted) when 'basename' then (select count(basename) from drifted) else 0 end as non_null
from compared""")
ORACLE["check_schema"] = with_(_DRIFT, """,
told as (select case problem when 'missing' then 0 when 'unexpected' then 1 else 2 end as kind, w_at, f_at,
    case problem when 'missing' then concat('missing column: ', name) when 'unexpected' then concat('unexpected column: ', name)
      else concat(name, ': expected ', expected, ', got ', found) end as text from compared where problem is not null),
placed as (select *, row_number() over (order by kind, w_at, f_at) as k from told)
select 'schema_conformance' as check_name, 'error' as severity, 'fail' as status, concat(count(*), ' schema problem(s)') as message,
  count(*) as violations, string_agg(text, '; ' order by k) filter (k <= 5) as samples from placed""")

_DUP = "(select *, count(*) over (partition by {k}) as copies from unclean)"
UNIQUE = verdict("ra_id_unique", _DUP.format(k="ra_id"), "copies > 1", "ra_id", "ra_id is unique",
                 "concat(n, ' duplicate ra_id row(s)')")
ORACLE["check_unique"] = with_(UNCLEAN, UNIQUE)
ORACLE["check_unique_composite"] = with_(UNCLEAN, verdict(
    "ra_number_year_unique", _DUP.format(k="ra_number, ra_year"), "copies > 1", "cast(to_json({'ra_number': ra_number, 'ra_year': ra_year}) as varchar)",
    "ra_number, ra_year is unique", "concat(n, ' duplicate ra_number, ra_year row(s)')"))
ORACLE["check_required_non_null"] = with_(LABELLED, """,
counts as (select count(*) filter (quality is null) as q, count(*) filter (toxic is null) as t from labelled)
select 'required_non_null' as check_name, 'error' as severity, 'fail' as status, '3 column(s) have nulls' as message,
  cast(3 as bigint) as violations,
  concat('missing_one: column missing; quality: ', q, ' null(s); toxic: ', t, ' null(s)') as samples from counts""")
ORACLE["check_year_range"] = with_(UNCLEAN, verdict(
    "year_range", "unclean", "ra_year < 1950 or ra_year > 2020", "ra_year", "All ra_year values in [1950, 2020]",
    "concat(n, ' ra_year value(s) out of range')", shown="cast(v as varchar)"))


def stub_sql(min_words: int) -> str:
    return verdict(
        "content_non_stub", "unclean", f"content_length < 1 or word_count < {min_words}", "ra_id",
        "All rows have non-empty content",
        f"concat(n, ' stub row(s) (content_length<1 or word_count<{min_words})')", per_value=True)


ORACLE["check_content_non_stub"] = with_(UNCLEAN, stub_sql(200))
NON_EMPTY = verdict(
    "content_normalized_non_empty", "unclean", "coalesce(length(content_normalized), 0) = 0", "ra_id",
    "All content_normalized values non-empty", "concat(n, ' row(s) have empty content_normalized')")
ORACLE["check_non_empty"] = with_(UNCLEAN, NON_EMPTY)


def pattern_sql(pattern: str) -> str:
    return verdict(
        "ra_number_shape", "unclean", f"not coalesce(regexp_matches(ra_number, '{pattern}'), false)", "ra_number",
        f"All ra_number values match '{pattern}'", "concat(n, ' ra_number value(s) do not match expected shape')")


ORACLE["check_pattern"] = with_(UNCLEAN, pattern_sql(r"^[1-9]\d{0,1}$"))


def date_sql(source: str) -> str:
    return f"""
select 'approval_date_valid' as check_name, 'error' as severity, case when n = 0 then 'pass' else 'fail' end as status,
  case when n = 0 then concat('All ', non_null, ' non-null approval_date values are valid ISO dates')
       else concat(n, ' approval_date value(s) invalid') end as message, n as violations,
  coalesce((select string_agg(v, '; ' order by v) from (select distinct v from ({_bad_dates(source)}) order by v limit 5)), '')
    as samples
from (select count(*) as n from ({_bad_dates(source)})), (select count(approval_date) as non_null from {source})"""


def _bad_dates(source: str) -> str:
    return f"""select concat('non-ISO: ', approval_date) as v from {source}
      where not regexp_matches(approval_date, '{K.ISO_DATE}')
    union all select concat('unparseable: ', approval_date) from {source}
      where approval_date is not null and try_strptime(approval_date, '%Y-%m-%d') is null"""


ORACLE["check_date_valid"] = with_(ISO_TEXTS, date_sql("iso_texts"))


def distribution_sql(source: str) -> str:
    return f"""
select 'source_distribution' as check_name, 'warn' as severity, case when count(*) > 1 then 'warn' else 'pass' end as status,
  concat('source distribution: {{', string_agg(concat('''', source, ''': ', n), ', ' order by n desc, source), '}}') as message,
  cast(0 as bigint) as violations, '' as samples
from (select source, count(*) as n from {source} group by source)"""


ORACLE["check_source_distribution"] = distribution_sql("documents")


def oversized_sql(limit: int) -> str:
    return f"""
select 'oversized_content' as check_name, 'warn' as severity, case when n = 0 then 'pass' else 'warn' end as status,
  case when n = 0 then 'No rows exceed {limit:,} chars' else concat(n, ' row(s) exceed {limit:,} chars') end as message,
  n as violations,
  coalesce((select string_agg(concat(ra_id, ' (', format('{{:,}}', content_length), ' chars)'), '; '
            order by content_length desc, ra_id)
   from (select distinct ra_id, content_length from unclean where content_length > {limit}
         order by content_length desc, ra_id limit 5)), '') as samples
from (select count(*) as n from unclean where content_length > {limit})"""


ORACLE["check_oversized"] = with_(UNCLEAN, oversized_sql(5000))
_CONSTRAINTS = {
    "ra_year_range": "ra_year between 1946 and 2100",
    "ra_id_shape": "regexp_matches(ra_id, '^RA-[0-9]+[A-Z]?$')",
    "ra_number_shape": "regexp_matches(ra_number, '^[0-9]+[a-z]?$')",
    "source_allowed": "source in ('" + "', '".join(K.ALLOWED_SOURCES) + "')",
    "word_count_nonneg": "word_count >= 0",
    "content_length_nonneg": "content_length >= 0",
    "source_path_nonempty": "length(source_path) > 0",
}
ORACLE["check_constraints"] = with_(UNCLEAN, "\nunion all\n".join(
    verdict(name, "unclean", f"not ({p})", "ra_id", "constraint holds", "concat(n, ' row(s) violate it')")
    for name, p in _CONSTRAINTS.items()))
ORACLE["check_null_rate"] = with_(UNCLEAN, """
select 'approval_date_null_rate' as check_name, 'error' as severity,
  case when nulls / n_rows > 0.005 then 'fail' else 'pass' end as status,
  case when nulls / n_rows > 0.005 then 'approval_date null rate above 0.005'
       else 'approval_date null rate within 0.005' end as message, nulls as violations, '' as samples
from (select count(*) filter (approval_date is null) as nulls, count(*) as n_rows from unclean)""")
ORACLE["check_row_band"] = """
select 'row_band' as check_name, 'error' as severity, case when n between 11000 and 13000 then 'pass' else 'fail' end as status,
  case when n between 11000 and 13000 then 'row count in [11000, 13000]' else concat('unexpected row count: ', n) end as message,
  cast(case when n between 11000 and 13000 then 0 else 1 end as bigint) as violations, '' as samples
from (select count(*) as n from documents)"""

_low, _high = _contract.years(TODAY)
REPORT = "\nunion all\n".join(f"select * from ({part})" for part in [
    """select 'schema_conformance' as check_name, 'error' as severity, 'pass' as status,
       'All expected columns present with expected types' as message, cast(0 as bigint) as violations, '' as samples""",
    UNIQUE,
    "select 'required_non_null' as check_name, 'error' as severity, case when n = 0 then 'pass' else 'fail' end as status, "
    "case when n = 0 then 'All required fields non-null' else concat(n, ' column(s) have nulls') end as message, "
    "n as violations, samples from (select count(*) as n, "
    "coalesce(string_agg(concat(c, ': ', k, ' null(s)'), '; ' order by c), '') as samples from ("
    + " union all ".join(f"select '{c}' as c, count(*) filter ({c} is null) as k from unclean" for c in _required)
    + ") where k > 0)",
    verdict("year_range", "unclean", f"ra_year < {_low} or ra_year > {_high}", "ra_year",
            f"All ra_year values in [{_low}, {_high}]", "concat(n, ' ra_year value(s) out of range')",
            shown="cast(v as varchar)"),
    stub_sql(K.MIN_WORD_COUNT), NON_EMPTY, pattern_sql(r"^\d+[a-z]?$"), date_sql("unclean"),
    distribution_sql("unclean"), oversized_sql(K.OVERSIZED_CHARS),
])
ORACLE["validation_report"] = with_(UNCLEAN, REPORT)
ORACLE["validation_isolated"] = with_(UNCLEAN, REPORT + """
union all select 'year_not_there', 'error', 'fail', 'check crashed: SparkRuntimeException: USER_RAISED_EXCEPTION', 0, ''
union all select 'broken_udf', 'error', 'fail', 'check crashed: PythonException: ValueError: not a year', 0, ''
union all select 'title_null_rate', 'error', case when count(*) filter (title is null) > 0.005::double * count(*) then 'fail' else 'pass' end,
  case when count(*) filter (title is null) > 0.005::double * count(*) then 'title null rate above 0.005' else 'title null rate within 0.005' end,
  count(*) filter (title is null), '' from unclean""")
_RULES = ", ".join(f"({at}, '{name}', '{rule.severity}', {lit(json.dumps(rule.params, sort_keys=True))})"
                   for at, (name, rule) in enumerate(_contract.rules.items(), 1))
ORACLE["contract_rules"] = with_(UNCLEAN, f"""
select cast(rule_id as integer) as rule_id, check_name, declared, params, status, violations, '{_contract.revision}' as revision,
  cast({len(_required)} as integer) as n_required, cast({_low} as integer) as year_low, cast({_high} as integer) as year_high
from (values {_RULES}) t(rule_id, check_name, declared, params) join ({REPORT}) using (check_name)""")
ORACLE["validation_summary"] = with_(UNCLEAN, f"""
select count(*) as total_checks, count(*) filter (status = 'pass') as passed, count(*) filter (status = 'warn') as warned,
  count(*) filter (status = 'fail') as failed,
  case when bool_or(status = 'fail') then 'fail' when bool_or(status = 'warn') then 'warn' else 'pass' end as overall_status
from ({REPORT})""")

# --- profiles --------------------------------------------------------------

_COLUMNS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
            ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]


def _rendered(x: str) -> str:
    flat = strip(rf"replace(regexp_replace(cast({x} as varchar), '[\n\r]', ' ', 'g'), '|', '\|')")
    return f"case when length({flat}) > 80 then concat(substr({flat}, 1, 79), '…') else {flat} end"


def profile_sql(table: str, columns: list[tuple[str, str]], order: str) -> str:
    return "\nunion all\n".join(f"""
select '{c}' as name, {at} as position, '{t}' as dtype, count({c}) as non_null, count(*) - count({c}) as nulls,
  round(100.0 * (count(*) - count({c})) / count(*)::double, 2) as null_pct, count(distinct {c}) as distinct_values,
  coalesce((select {_rendered(c)} from {table} where {c} is not null order by {order} limit 1), '') as sample
from {table}""" for at, (c, t) in enumerate(columns))


def null_notes_sql(profile: str) -> str:
    return f"""
select name, case when null_pct >= {K.HIGH_NULL_PCT} then 'high' else 'low' end as level, nulls, null_pct,
  case when null_pct >= {K.HIGH_NULL_PCT}
       then concat('`', name, '` is ', printf('%.2f', null_pct), '% null (', nulls, '/', non_null + nulls, ').')
       else concat('`', name, '` has ', nulls, ' null(s) (', printf('%.2f', null_pct), '%).') end as note
from ({profile}) where nulls > 0"""


_PROFILE = profile_sql("labelled", _COLUMNS, "doc_id")
ORACLE["column_profile"] = with_(LABELLED, _PROFILE)
ORACLE["null_issues"] = with_(LABELLED, null_notes_sql(_PROFILE))
_SUMMARY = """select '{c}' as name, count(v) as count, min(v) as min, round(quantile_cont(v, 0.25), 6) as p25,
  round(quantile_cont(v, 0.5), 6) as median, round(avg(v), 6) as mean, round(quantile_cont(v, 0.75), 6) as p75,
  max(v) as max from (select {x} as v from events) where v is not null"""
ORACLE["numeric_summary"] = "\nunion all\n".join([
    _SUMMARY.format(c="value", x="value"),
    _SUMMARY.format(c="k", x="try_cast(json_extract_string(props, '$.k') as double)"),
])
ORACLE["duplicate_content_count"] = "select count(*) - count(distinct text) as duplicates from documents"
ORACLE["regex_count_profile"] = with_(ACTS, f"""
select count(*) filter (regexp_matches(basename, '{K.INDEX_BASENAME}')) as index_basename_rows,
  count(*) filter (regexp_matches(content, '(?i)republic act')) as header_rows,
  count(*) filter (regexp_matches(content, '{K.APPROVED_LINE}')) as approved_rows from acts""")
_PROFILED = f"""(select *, try_cast({_LABEL} as bigint) as number, nullif(date_text, '') as day,
  case when regexp_matches(date_text, '{K.ISO_DATE}') then cast(substr(date_text, 1, 4) as bigint) end as year from entries)"""
_METRICS = {
    "total_rows": "count(*)", "label_rows": "count(number)", "other_rows": "count(*) - count(number)",
    "dates_present": "count(day)", "dates_iso": "count(year)", "dates_non_iso": "count(day) - count(year)",
    "anchors_present": "count(anchor)", "doc_ids_extracted": "count(anchor)",
    "number_min": "min(number)", "number_max": "max(number)", "year_min": "min(year)", "year_max": "max(year)",
    "pages": "count(distinct page)",
}
ORACLE["json_index_profile"] = with_(ENTRIES, "\nunion all\n".join(
    [f"select '{m}' as metric, {x} as value from {_PROFILED}" for m, x in _METRICS.items()]
    + [f"select 'per_page_{f}', {f}(n) from (select count(*) as n from entries group by page)" for f in ("min", "max")]
    + [f"select 'duplicate_numbers', count(*) from (select number from {_PROFILED} where number is not null "
       "group by number having count(*) > 1)",
       "select concat('entries_of_length_', entry_size), count(*) from entries group by entry_size"]))
ORACLE["page_set_profile"] = with_(MANIFEST, """
select count(*) as manifest_entries, count(html) as pages_found, count(*) - count(html) as missing_pages,
  cast(coalesce(sum(strlen(html)), 0) as bigint) as total_bytes,
  cast(coalesce(sum(strlen(html)), 0) // greatest(count(html), 1) as bigint) as avg_page_bytes from listed""")
_STAGED_TYPES = [(c, "bigint" if c in ("ra_year", "content_length", "word_count") else "string") for c in K.STAGED_COLUMNS]
_STAGED_PROFILE = profile_sql("staged", _STAGED_TYPES, "source_path")


def cells_sql(part: str, table: str, metrics: list[str]) -> str:
    return "\nunion all\n".join(f"select '{part}' as part, name, '{m}' as metric, cast({m} as varchar) as value from {table}" for m in metrics)


ORACLE["staging_profile"] = with_(STAGED, f""",
profiled as ({_STAGED_PROFILE}), noted as ({null_notes_sql("from profiled")}),
numbers as ({" union all ".join(f"""select '{c}' as name, count(v) as count, round(min(v), 6) as min, round(quantile_cont(v, 0.25), 6) as p25,
    round(quantile_cont(v, 0.5), 6) as median, round(avg(v), 6) as mean, round(quantile_cont(v, 0.75), 6) as p75, round(max(v), 6) as max
  from (select cast({c} as double) as v from staged)""" for c in ("ra_year", "content_length", "word_count"))}),
derived as (select 'duplicate_ra_id' as metric, count(*) - count(distinct ra_id) as value from staged
  union all select 'rows', count(*) from staged
  union all select 'null_ra_year', count(*) filter (ra_year is null) from staged
  union all select 'ra_year_min', min(ra_year) from staged
  union all select 'ra_year_max', max(ra_year) from staged
  union all select 'empty_title', count(*) filter (trim(title) = '') from staged)
{cells_sql("column", "profiled", ["position", "dtype", "non_null", "nulls", "null_pct", "distinct_values", "sample"])}
union all {cells_sql("numeric", "numbers", ["count", "min", "p25", "median", "mean", "p75", "max"])}
union all select 'derived', '', metric, cast(value as varchar) from derived
union all {cells_sql("note", "noted", ["level", "note"])}""")

# --- calendar --------------------------------------------------------------

ORACLE["count_by_year"] = "select year(o_orderdate) as year, count(*) as n from orders group by 1 order by 1"
ORACLE["count_by_month"] = """
select m as month, count(o_orderkey) as n from range(1, 13) r(m) left join orders on month(o_orderdate) = m
group by m order by m"""
ORACLE["count_by_weekday"] = """
select w as weekday, count(o_orderkey) as n from range(0, 7) r(w) left join orders on isodow(o_orderdate) - 1 = w
group by w order by w"""

# --- term statistics and search --------------------------------------------

_STOPS = ", ".join(lit(w) for w in STOP_WORDS)
TERMS = f"""
all_words as (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) as term from documents),
all_terms as (select doc_id, term, count(*) as tf from all_words group by doc_id, term),
terms as (select * from all_terms where term not in ({_STOPS})),
vocab as (select term, count(*) as df, cast(sum(tf) as bigint) as cf,
    ln((1.0 + (select count(*) from documents)::double) / (1.0 + count(*)::double)) + 1.0 as idf
  from terms group by term
  having count(*) >= {K.MIN_DF} and count(*) <= {K.MAX_DF}::double * (select count(*) from documents)
  order by cf desc, term limit {K.MAX_FEATURES}),
raw as (select doc_id, term, tf, tf * idf as w from terms join vocab using (term)),
weights as (select doc_id, term, tf, w / sqrt(sum(w * w) over (partition by doc_id)) as weight from raw),
langs as (select doc_id, cast(case lang when 'de' then 0 when 'en' then 1 when 'es' then 2 when 'fr' then 3 else 20 end
    as integer) as cluster, 1946 + doc_id % 80 as ra_year from documents),
sizes as (select cluster, count(*) as size from langs group by cluster),
centers as (select cluster, term, sum(weight) / any_value(size) as weight
  from weights join langs using (doc_id) join sizes using (cluster) group by cluster, term)"""

ORACLE["tokenize_terms"] = with_(TERMS, "select doc_id, term, tf from terms")
ORACLE["term_doc_freq"] = with_(
    TERMS, "select term, count(*) as df, cast(sum(tf) as bigint) as cf from all_terms group by term"
)
ORACLE["vocabulary_select"] = with_(TERMS, "select term, df, cf, round(idf, 6) as idf from vocab")
ORACLE["tfidf_weights"] = with_(TERMS, "select doc_id, term, tf, round(weight, 6) as weight from weights")
ORACLE["tfidf_matrix_stats"] = with_(TERMS, """
select (select count(*) from documents) as n_docs, (select count(*) from vocab) as n_terms, count(*) as nnz,
  round(100.0 * count(*) / ((select count(*) from documents) * (select count(*) from vocab))::double, 6) as density_pct
from weights""")
ORACLE["text_search_and"] = with_(TERMS, f""",
hits as (select * from all_terms where term in ({', '.join(lit(w) for w in SEARCH_WORDS)})),
freq as (select term, count(*) as df from hits group by term)
select doc_id, round(sum(tf * (ln((1.0 + (select count(*) from documents)::double) / (1.0 + df::double)) + 1.0)), 6) as score
from hits join freq using (term) group by doc_id having count(*) = {len(SEARCH_WORDS)} order by score desc, doc_id""")

# --- clusters --------------------------------------------------------------

_TOP = """
top as (select cluster, term, weight, row_number() over (partition by cluster order by round(weight, 9) desc, term) as rank
  from centers qualify rank <= 15)"""
_TERM_DISTANCE = """
gaps as (select doc_id, cluster, greatest(coalesce(own, 0) + c2 - 2 * coalesce(dot, 0), 0) as d2
  from langs join (select cluster, sum(weight * weight) as c2 from centers group by cluster) using (cluster)
  left join (select doc_id, sum(weight * weight) as own from weights group by doc_id) using (doc_id)
  left join (select doc_id, cluster, sum(w.weight * c.weight) as dot from weights w join langs using (doc_id)
             join centers c using (cluster, term) group by doc_id, cluster) using (doc_id, cluster)),
reps as (select cluster, doc_id, row_number() over (partition by cluster order by round(d2, 9), doc_id) as rank
  from gaps qualify rank <= 3)"""
ORACLE["cluster_top_terms"] = with_(
    TERMS + "," + _TOP, "select cluster, term, round(weight, 6) as weight, cast(rank as integer) as rank from top"
)
ORACLE["cluster_summary"] = with_(TERMS, """
select cluster, count(*) as size, min(ra_year) as year_min, max(ra_year) as year_max from langs group by cluster""")
ORACLE["cluster_theme_report"] = with_(TERMS + "," + _TOP + "," + _TERM_DISTANCE, """
select cluster, case cluster when 0 then 'German prose' when 1 then 'English prose' when 3 then 'French prose'
    else concat('Cluster ', cluster) end as theme,
  size, year_min, year_max, top_terms, representatives
from (select cluster, count(*) as size, min(ra_year) as year_min, max(ra_year) as year_max from langs group by cluster)
left join (select cluster, string_agg(term, ', ' order by rank) as top_terms from top where rank <= 10 group by cluster)
  using (cluster)
left join (select cluster, string_agg(concat(doc_id, ' (', 1946 + doc_id % 80, ') - ', substr(coalesce(text, ''), 1, 110)), '; ' order by rank)
    as representatives from reps join documents using (doc_id) group by cluster)
  using (cluster)""")
ORACLE["cluster_scatter_join"] = """
select vec_id as doc_id, label as cluster, replace(substr(coalesce(text, ''), 1, 90), chr(10), ' ') as title_short,
  case when text is null then '' else cast(1946 + doc_id % 80 as varchar) end as year_str, true as within_length
from embeddings left join documents on doc_id = vec_id"""
ORACLE["cluster_sizes"] = """
select count(*) as n_clusters, min(n) as size_min, max(n) as size_max,
  cast(floor(quantile_cont(n, 0.5)) as bigint) as size_median from (select count(*) as n from embeddings group by label)"""
VECTORS = """
cells as (select vec_id, label, generate_subscripts(embedding, 1) as dim, unnest(embedding)::double as v from embeddings),
means as (select label, dim, avg(v) as c from cells group by label, dim),
distances as (select vec_id, label, sum((v - c) * (v - c)) as d2 from cells join means using (label, dim) group by vec_id, label)"""
ORACLE["centroid_distance"] = with_(VECTORS, "select vec_id, label, round(d2, 6) as distance2 from distances")
ORACLE["cluster_representatives"] = with_(VECTORS, """
select label, cast(row_number() over (partition by label order by round(d2, 9), vec_id) as integer) as rank, vec_id
from distances qualify rank <= 3""")
ORACLE["cluster_inertia"] = with_(
    VECTORS, "select count(*) as n_rows, round(sum(d2), 6) as inertia from distances"
)
PAIRS = f"""
sampled as (select vec_id, label, embedding::double[] as e from embeddings
  order by md5(concat('42', vec_id)), vec_id limit {K.SILHOUETTE_SAMPLE}),
sums as (select a.vec_id, a.label, b.label as other, sum(list_distance(a.e, b.e)) as s, count(*) as n
  from sampled a, sampled b group by a.vec_id, a.label, b.label)"""
SWEEP = VECTORS + f""",
{PAIRS},
ks as (select unnest([{', '.join(map(str, SWEEP_KS))}])::integer as k),
kcells as (select k, vec_id, label % k as cluster, dim, v from cells, ks),
kmeans as (select k, cluster, dim, avg(v) as c from kcells group by k, cluster, dim),
kinertia as (select k, round(sum((v - c) * (v - c)), 6) as inertia from kcells join kmeans using (k, cluster, dim) group by k),
ksums as (select k, vec_id, label % k as own, other % k as other, sum(s) as s, sum(n) as n from sums, ks
  group by k, vec_id, label % k, other % k),
kpoints as (select k, vec_id, max(case when own = other and n > 1 then s / (n - 1) end) as a,
    min(case when own <> other then s / n end) as b from ksums group by k, vec_id),
kscores as (select k, round(avg(case when a is null or b is null then 0.0 else coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) end), 6)
    as silhouette from kpoints group by k),
sweep as (select k, inertia, silhouette from kinertia join kscores using (k)),
curve as (select k, silhouette, row_number() over (order by k) as pos,
    (k - min(k) over ()) / nullif(max(k) over () - min(k) over (), 0) as x,
    (inertia - min(inertia) over ()) / nullif(max(inertia) over () - min(inertia) over (), 0) as y from sweep),
chord as (select arg_min(x, k) as x0, arg_max(x, k) as x1, arg_min(y, k) as y0, arg_max(y, k) as y1 from curve),
bent as (select k, pos, silhouette, abs((x1 - x0) * (y - y0) - (y1 - y0) * (x - x0))
    / nullif(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)), 0) as d from curve, chord),
elbows as (select k as k_elbow, pos as elbow_pos from bent order by coalesce(d, 0) desc, k limit 1)"""
ORACLE["silhouette_exact"] = with_(PAIRS, """,
points as (select vec_id, max(case when label = other and n > 1 then s / (n - 1) end) as a,
  min(case when label <> other then s / n end) as b from sums group by vec_id)
select round(avg(case when a is null or b is null then 0.0 else coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) end), 6)
  as silhouette, count(*) as n_points from points""")
ORACLE["label_sweep"] = with_(SWEEP, "select k, inertia, silhouette from sweep")
ORACLE["elbow_k"] = with_(SWEEP, "select k_elbow from elbows")
ORACLE["select_k"] = with_(SWEEP, f""",
peak as (select k as k_silhouette_max, silhouette as top from sweep order by silhouette desc, k limit 1),
near as (select k as k_silhouette_near_elbow, silhouette as near from bent, elbows
  where pos between elbow_pos and elbow_pos + 2 order by silhouette desc, k limit 1),
chosen as (select *, top - near as margin,
    greatest(case when top - near < {K.FLAT_MARGIN} then k_silhouette_near_elbow else k_silhouette_max end, {K.K_FLOOR}) as k_final
  from peak, near, elbows)
select k_silhouette_max, k_elbow, k_silhouette_near_elbow, k_final,
  k_final = {K.K_FLOOR} and k_final <> k_silhouette_max as k_floor_applied,
  case when margin < {K.FLAT_MARGIN} then 'silhouette_flat_near_elbow' else 'silhouette_max' end as decision_reason,
  round(margin, 6) as silhouette_margin, {K.FLAT_MARGIN}::double as flat_margin_threshold from chosen""")

# --- fitted models ------------------------------------------------------------

ORACLE["kmeans_assign"] = "select vec_id, true as is_nearest from embeddings"
ORACLE["k_sweep"] = f"""
select cast(k as integer) as k, (select count(*) from embeddings) as n_points, k as n_clusters, true as all_nearest,
  true as inertia_agrees, true as silhouette_valid from range({K.K_MIN}, {K.K_MAX} + 1) t(k)"""
_PARAMETERS = json.dumps({"k_min": K.K_MIN, "k_max": K.K_MAX, "n_init": K.N_INIT, "seed": K.SEED, "min_df": K.MIN_DF,
                          "max_df": K.MAX_DF, "max_features": K.MAX_FEATURES}, sort_keys=True)
ORACLE["cluster_metrics"] = with_(TERMS, f"""
select cast((select count(*) from documents) as integer) as n_docs_fit, cast((select count(*) from vocab) as integer) as vocabulary_size,
  {lit(_PARAMETERS)} as parameters, cast({K.K_MAX - K.K_MIN + 1} as integer) as n_swept, cast({K.K_FLOOR} as integer) as k_floor,
  true as k_in_range, true as final_fit_agrees, true as silhouette_valid""")
ORACLE["svd_project"] = """
select cast(c as integer) as component, (select count(*) from documents) as n_rows, true as unit_loading, true as orthogonal,
  true as norm_agrees, true as ordered from range(1, 3) t(c)"""
ORACLE["svd_explained"] = """
select cast(50 as integer) as components, (select count(*) from documents) as n_rows, true as share_valid, true as share_agrees"""
