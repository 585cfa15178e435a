"""Registry of named queries and their SQL oracles.

Each entry: ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
A ``None`` oracle marks an operator that is not SQL-expressible; those
are checked against a brute-force specification in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bidlake.plans import notices as PN
from bidlake.plans import oracle as O
from bidlake.settings import NOTICE_COLUMNS
from bidlake.sources import standins as S

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


_OWNED = ", ".join(NOTICE_COLUMNS)

# --- feed A ------------------------------------------------------------------

register("notice_ingest", f"""
WITH {O.ITEMS_CTE.strip()},
{O.MASTER_CTE.strip()},
{O.PASSED_CTE.strip()},
{O.accepted_cte(None, S.STANDIN_RUN_TS)}
SELECT {_OWNED},
       CAST(row_number() OVER (ORDER BY postedDate DESC, ord) AS BIGINT) AS row_pos
FROM accepted
""")(PN.notice_ingest)

_NOTICE_BASE = f"WITH {O.ITEMS_CTE.strip()},\n{O.MASTER_CTE.strip()},\n{O.PASSED_CTE.strip()}"
_KEYED = f"k AS (SELECT ord, {O.blank_sql('noticeId')} AS noticeId, {O.blank_sql('naicsCode')} AS naicsCode, " \
         f"fullParentPathName, postedDate, title, organizationCode FROM items)"


def _days_before(run_date: str, days: int) -> str:
    from datetime import date, timedelta
    return (date.fromisoformat(run_date) - timedelta(days=days)).isoformat()


def _mdy(iso: str) -> str:
    y, m, d = iso.split("-")
    return f"{m}/{d}/{y}"


_SECTOR = " OR ".join(f"starts_with(naicsCode, {O.q(p)})" for p in PN.STANDIN_SETTINGS.excluded_prefixes)

register("sector_prefix_filter", f"""{_NOTICE_BASE},
{_KEYED}
SELECT ord, noticeId, naicsCode FROM k WHERE naicsCode = '' OR NOT ({_SECTOR})
""")(PN.sector_prefix_filter)

register("exact_code_filter", f"""{_NOTICE_BASE},
{_KEYED}
SELECT ord, noticeId, naicsCode FROM k
WHERE naicsCode = '' OR naicsCode NOT IN {O.in_list(PN.STANDIN_SETTINGS.excluded_codes)}
""")(PN.exact_code_filter)

register("department_filter", f"""{_NOTICE_BASE},
{_KEYED}
SELECT ord, noticeId, fullParentPathName FROM k WHERE {O.dept_ok_sql('fullParentPathName')}
""")(PN.department_filter)

_LB_FROM = _days_before(S.STANDIN_RUN_DATE, PN.STANDIN_SETTINGS.days_back)
register("lookback_window", f"""{_NOTICE_BASE},
{_KEYED}
SELECT ord, noticeId, substr(coalesce(postedDate, ''), 1, 10) AS postedDate FROM k
WHERE substr(coalesce(postedDate, ''), 1, 10) >= '{_LB_FROM}' AND substr(coalesce(postedDate, ''), 1, 10) <= '{S.STANDIN_RUN_DATE}'
""")(PN.lookback_window)

_SQ = PN.SOURCE_QUERY
register("source_predicates", f"""{_NOTICE_BASE},
{_KEYED}
SELECT ord, noticeId, title, organizationCode FROM k
WHERE substr(coalesce(postedDate, ''), 1, 10) >= '{_SQ['posted_from']}'
  AND substr(coalesce(postedDate, ''), 1, 10) <= '{_SQ['posted_to']}'
  AND organizationCode = '{_SQ['organization_code']}'
  AND contains(lower(coalesce(title, '')), '{_SQ['keyword']}')
""")(PN.source_predicates)

register("first_wins_dedup", f"""{_NOTICE_BASE}
SELECT ord, _nid AS noticeId, _code AS naicsCode FROM firsts
""")(PN.first_wins_dedup)

register("anti_join_master", f"""{_NOTICE_BASE}
SELECT ord, _nid AS noticeId FROM keyed
WHERE _nid <> '' AND _nid NOT IN (SELECT _nid FROM master_keys)
""")(PN.anti_join_master)

register("strict_cap", f"""{_NOTICE_BASE},
{O.accepted_cte(PN.TEN_PAGES, S.STANDIN_RUN_TS)}
SELECT ord, noticeId, postedDate FROM accepted
""")(PN.strict_cap)

_PS = PN.STANDIN_SETTINGS.page_size
register("stable_sort_pages", f"""{_NOTICE_BASE},
{O.accepted_cte(None, S.STANDIN_RUN_TS)},
pos AS (SELECT *, CAST(row_number() OVER (ORDER BY postedDate DESC, ord) AS BIGINT) AS row_pos FROM accepted)
SELECT noticeId, postedDate, row_pos, CAST(floor((row_pos - 1) / {_PS}) AS BIGINT) AS page,
       CAST((row_pos - 1) % {_PS} AS BIGINT) AS slot
FROM pos
""")(PN.stable_sort_pages)

_AGENCY_COUNTS = f"""{_NOTICE_BASE},
{O.accepted_cte(None, S.STANDIN_RUN_TS, agency='organizationCode')},
codes_q AS (SELECT CAST(r_regionkey AS BIGINT) AS code_seq, CAST(r_regionkey AS VARCHAR) AS agencyCode FROM region),
counted AS (SELECT agencyCodeQueried AS agencyCode, count(*) AS n FROM accepted GROUP BY 1),
agency_counts AS (
  SELECT code_seq, agencyCode, CAST(coalesce(n, 0) AS BIGINT) AS newRows
  FROM codes_q LEFT JOIN counted USING (agencyCode)
)"""

register("agency_counts", f"""{_AGENCY_COUNTS}
SELECT * FROM agency_counts
""")(PN.agency_counts)

register("run_log_row", f"""{_AGENCY_COUNTS}
SELECT {O.q(S.STANDIN_RUN_TS)} AS runAtUTC,
       '{_mdy(_LB_FROM)}' AS postedFrom,
       '{_mdy(S.STANDIN_RUN_DATE)}' AS postedTo,
       coalesce(string_agg(agencyCode, ',' ORDER BY code_seq), 'ALL') AS agencies,
       '' AS keyword,
       CAST(coalesce(sum(newRows), 0) AS BIGINT) AS newRows,
       coalesce(string_agg(CASE WHEN newRows > 0 THEN agencyCode || ':' || CAST(newRows AS VARCHAR) END, '; '
                           ORDER BY code_seq), 'no new rows') AS notes
FROM agency_counts
""")(PN.run_log_row)

_OLD_MASTER_COLS = [c for c in NOTICE_COLUMNS if c not in ("deadline", "oppUrl")] + [
    "fitLabel", "reviewSummary", "deadlineNote", "deadlineISO", "reviewedAtUTC", "emailedAtUTC"]
_EVOLVED = _OLD_MASTER_COLS + ["oppUrl", "deadline"]
register("schema_evolution_union", f"""{_NOTICE_BASE},
{O.accepted_cte(None, S.STANDIN_RUN_TS)}
SELECT {', '.join(_OLD_MASTER_COLS)}, '' AS oppUrl, '' AS deadline FROM master
UNION ALL
SELECT {', '.join(c if c in NOTICE_COLUMNS else "'' AS " + c for c in _EVOLVED)} FROM accepted
""")(PN.schema_evolution_union)

# --- feed C ------------------------------------------------------------------

_RECHECK_BASE = f"""{_NOTICE_BASE},
{O.FRESH_CTE.strip()},
{O.recheck_cte(S.STANDIN_RUN_DATE).strip()}"""

register("recheck_join", f"""{_RECHECK_BASE}
SELECT noticeId, _mposted AS postedDate, fresh_ord, fresh_title, fresh_naicsCode, fresh_type, fresh_deadline
FROM matched
""")(PN.recheck_join)

register("recheck_diff", f"""{_RECHECK_BASE}
SELECT noticeId, postedDate, CAST(fresh_ord IS NOT NULL AS INTEGER) AS matched, changed_fields FROM diffed2
""")(PN.recheck_diff)

_MASTER_COLS = list(NOTICE_COLUMNS) + ["fitLabel", "reviewSummary", "deadlineNote", "deadlineISO",
                                       "reviewedAtUTC", "emailedAtUTC"]


def _upsert_col(c: str) -> str:
    if c in ("title", "naicsCode", "type", "deadline"):
        return f"CASE WHEN _chg_{c} THEN fresh_{c} ELSE {c} END AS {c}"
    if c in ("fitLabel", "reviewSummary", "deadlineNote", "reviewedAtUTC"):
        return f"CASE WHEN changed THEN '' ELSE {c} END AS {c}"
    return c


register("recheck_upsert", f"""{_RECHECK_BASE}
SELECT {', '.join(_MASTER_COLS)} FROM master
WHERE NOT (lower({O.blank_sql('fitLabel')}) = 'high' AND coalesce(noticeId, '') <> '')
UNION ALL
SELECT {', '.join(_upsert_col(c) for c in _MASTER_COLS)} FROM diffed2
""")(PN.recheck_upsert)

register("recheck_counts", f"""{_RECHECK_BASE}
SELECT CAST(count(*) AS BIGINT) AS checked, CAST(count_if(changed) AS BIGINT) AS updated FROM diffed2
""")(PN.recheck_counts)

# --- feed B, relational half -------------------------------------------------

from bidlake.plans import mail as PM  # noqa: E402
from bidlake.settings import PIPELINE_COLUMNS  # noqa: E402

register("normalize_text", f"""
SELECT doc_id, {O.normalize_text_sql('text')} AS normalized FROM documents
""")(PM.normalize_text)

register("language_flag", f"""
SELECT doc_id, {O.language_sql('text')} AS language FROM documents
""")(PM.language_flag)

_MAIL_BASE = f"WITH {O.mail_opps_cte().strip()}"

register("duplicate_key", f"""{_MAIL_BASE}
SELECT ord, source, duplicateKey FROM mail_keyed
""")(PM.duplicate_key)

register("mail_append_classified", f"""{_MAIL_BASE}
SELECT ord, appendStatus FROM mail_class
""")(PM.mail_append_classified)


def _pipeline_col(c: str) -> str:
    exprs = {
        "source": "source", "opportunityTitle": "coalesce(text, '')", "donorClient": "coalesce(lang, '')",
        "countryRegion": "coalesce(countryRegion, '')", "language": O.language_sql("text"),
        "duplicateKey": "duplicateKey", "processedAtUTC": O.q(S.STANDIN_RUN_TS), "pipelineStatus": "'New'",
    }
    return f"{exprs.get(c, chr(39) * 2)} AS {c}"


register("mail_new_rows", f"""{_MAIL_BASE}
SELECT ord, {', '.join(_pipeline_col(c) for c in PIPELINE_COLUMNS)} FROM mail_class WHERE appendStatus = 'new'
""")(PM.mail_new_rows)

register("append_summary", f"""{_MAIL_BASE}
SELECT CAST(count_if(appendStatus = 'new') AS BIGINT) AS appended,
       CAST(count_if(appendStatus <> 'new') AS BIGINT) AS skipped,
       CAST(count(*) AS BIGINT) AS total_processed
FROM mail_class
""")(PM.append_summary)

# --- pages: URL rules and links ----------------------------------------------

from bidlake.functions import urls as _U  # noqa: E402
from bidlake.operators import filters as _F  # noqa: E402
from bidlake.plans import pages as PP  # noqa: E402

register("clean_url", f"""
SELECT page_id, {O.clean_url_sql('url')} AS clean_url FROM pages
""")(PP.clean_url)

register("tracking_decode", f"""
SELECT page_id, {O.decode_tracking_sql(O.q(PP.TRACKER_BASE) + ' || url_encode(url)')} AS decoded FROM pages
""")(PP.tracking_decode)

register("url_deny_list", f"""
SELECT page_id,
       CAST(regexp_matches(coalesce(url, ''), {O.q(_U.DEVEX_SKIP_PATTERN)}) AS INTEGER) AS devex_skip,
       CAST(regexp_matches(coalesce(url, ''), {O.q(_U.DA_SKIP_PATTERN)}) AS INTEGER) AS da_skip,
       CAST(regexp_matches(coalesce(url, ''), {O.q(_U.DA_LISTING_PATTERN)}) AS INTEGER) AS da_listing
FROM pages
""")(PP.url_deny_list)

_LINKS = f"WITH {O.anchors_cte().strip()}"

register("page_links", f"""{_LINKS}
SELECT page_id, link_pos, href, text AS title FROM links
""")(PP.page_links)


def _generic_sql(title: str, generic) -> str:
    return f"CASE WHEN lower({title}) IN {O.in_list(generic)} THEN '' ELSE {title} END"


register("link_dedup_title", f"""{_LINKS},
dec AS (SELECT page_id, link_pos, {O.decode_tracking_sql(O.strip_sql('href'))} AS url, text FROM links),
kept AS (
  SELECT page_id, link_pos, url, {_generic_sql('text', _F.GENERIC_TITLES_DEVEX)} AS title FROM dec
  WHERE NOT regexp_matches(coalesce(url, ''), {O.q(_U.DEVEX_SKIP_PATTERN)})
),
ok AS (
  SELECT *, lower({O.strip_sql('title')}) AS _tkey FROM kept
  WHERE length(title) >= {PP.PAGES_MIN_TITLE_LEN} AND NOT regexp_matches(title, {O.q(_F.GENERIC_LABEL_PATTERN)})
)
SELECT page_id, link_pos, url, title FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, _tkey ORDER BY link_pos) AS _rn FROM ok) t
WHERE _rn = 1
""")(PP.link_dedup_title)

register("link_dedup_url", f"""{_LINKS},
abs_links AS (SELECT page_id, link_pos, {O.strip_sql(O.q(PP.DA_LISTING_BASE) + ' || href')} AS href, text FROM links),
kept AS (
  SELECT page_id, link_pos, href, {_generic_sql('text', _F.GENERIC_TITLES_DA)} AS title FROM abs_links
  WHERE NOT regexp_matches(href, {O.q(_U.DA_SKIP_PATTERN)}) AND regexp_matches(href, {O.q(_U.DA_LISTING_PATTERN)})
),
ok AS (SELECT *, {O.clean_url_sql('href')} AS url FROM kept WHERE title <> '' AND length(title) >= {PP.PAGES_MIN_TITLE_LEN})
SELECT page_id, link_pos, url, title FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY link_pos) AS _rn FROM ok) t
WHERE _rn = 1
""")(PP.link_dedup_url)

# --- conversations / events / dates ------------------------------------------

from bidlake.plans import parts as PX  # noqa: E402
from bidlake.settings import PREVIEW_ROWS  # noqa: E402

_W = "WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"
register("sibling_metadata", f"""
SELECT conv_id, turn, donor, country, deadline, status FROM (
  SELECT conv_id, turn, role,
         coalesce(lead({O.strip_sql('text')}, 1) OVER w, '') AS donor,
         coalesce(lead({O.strip_sql('text')}, 2) OVER w, '') AS country,
         coalesce(lead({O.strip_sql('text')}, 3) OVER w, '') AS deadline,
         {O.strip_sql("coalesce(string_split(text, chr(10))[2], '')")} AS status
  FROM conversations {_W}) t
WHERE role = 'user'
""")(PX.sibling_metadata)

register("first_body_part", f"""
SELECT conv_id AS message_id,
       coalesce(arg_min(text, CASE WHEN role = '{PX.BODY_MIME}' AND coalesce(text, '') <> '' THEN turn END), '') AS body
FROM conversations GROUP BY conv_id
""")(PX.first_body_part)

register("header_map", f"""
SELECT conv_id,
       {', '.join(f"coalesce(arg_max(text, turn) FILTER (WHERE lower(role) = '{r}'), '') AS {n}" for n, r in PX.HEADER_ROLES.items())},
       CAST(count(DISTINCT lower(role)) AS BIGINT) AS n_headers
FROM conversations GROUP BY conv_id
""")(PX.header_map)

_LABEL_KEY = ("lower(" + O.strip_sql("regexp_replace(" + O.strip_sql(
    "' ' || upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || ':'") + ", ':+$', '')") + ")")
_LABELS = f"""WITH lr AS (
  SELECT user_id, ts, event_id, {_LABEL_KEY} AS label, json_extract_string(props, '$.k') AS value FROM events
),
last AS (
  SELECT user_id, label, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, label ORDER BY ts DESC, event_id DESC) AS _rn
    FROM lr WHERE label <> '') t
  WHERE _rn = 1
)"""

register("label_value_map", f"""{_LABELS}
SELECT user_id, label, value FROM last
""")(PX.label_value_map)

_SYN = ", ".join(f"max(CASE WHEN label = '{k}' THEN value END)" for k in PX.EVENT_SYNONYMS)
register("synonym_lookup", f"""{_LABELS}
SELECT user_id, substr(coalesce({_SYN}, ''), 1, 100) AS value FROM last GROUP BY user_id
""")(PX.synonym_lookup)

register("per_source_limit", f"""
SELECT event_type, event_id FROM (
  SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS _rn FROM events) t
WHERE _rn <= {PX.PER_SOURCE_LIMIT}
""")(PX.per_source_limit)

register("mail_date", f"""
SELECT o_orderkey, strftime(o_orderdate, '%a, %-d %b %Y') || '{PX.RFC_TIME_SUFFIX}' AS date_header,
       strftime(o_orderdate, '%Y-%m-%d') AS email_date
FROM orders
""")(PX.mail_date)

register("deadline_iso", """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%B %-d, %Y')
                            WHEN '2-HIGH' THEN strftime(o_orderdate, '%d %b, %Y')
                            WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%-d/%-m/%Y')
                            WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d')
                            ELSE '' END AS deadline,
       CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '4-NOT SPECIFIED' AND day(o_orderdate) <= 12
              THEN strftime(o_orderdate, '%Y-%d-%m')  -- day first: the last part is a month
            WHEN o_orderstatus = 'P' OR o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d')
            ELSE '' END AS deadlineISO
FROM orders
""")(PX.deadline_iso)

# the date as written; numbers alone are day first where both can be meant, missing parts are the run's
register("deadline_lenient", f"""
SELECT o_orderkey,
       CASE form WHEN 0 THEN strftime(d, '%A, %-d %B %Y') || ' 17:00 UTC' WHEN 1 THEN strftime(d, '%-d') || 'th of ' || strftime(d, '%B, %Y')
                 WHEN 2 THEN strftime(d, '%Y %b %-d') WHEN 3 THEN strftime(d, '%b. %-d %Y') || ' at 5pm' WHEN 4 THEN strftime(d, '%Y%m%d')
                 WHEN 5 THEN strftime(d, '%-d-%b-%y') WHEN 6 THEN strftime(d, '%m/%d/%Y') WHEN 7 THEN strftime(d, '%-d . %-m . %Y')
                 WHEN 8 THEN strftime(d, '%B %Y') WHEN 9 THEN strftime(d, '%-d %B') WHEN 10 THEN 'closes ' || strftime(d, '%-d %B %Y')
                 ELSE strftime(d, '%-d %B %Y') || ' 12 13' END AS deadline,
       CASE WHEN form >= 10 THEN ''
            WHEN form IN (4, 6) AND day(d) <= 12 THEN strftime(d, '%Y-%d-%m')
            WHEN form = 8 THEN strftime(d, '%Y-%m-') || '{S.STANDIN_RUN_DATE[8:]}'
            WHEN form = 9 AND month(d) = 2 AND day(d) = 29 THEN ''
            WHEN form = 9 THEN '{S.STANDIN_RUN_DATE[:4]}' || strftime(d, '-%m-%d')
            ELSE strftime(d, '%Y-%m-%d') END AS deadlineISO
FROM (SELECT o_orderkey, o_orderkey % 12 AS form, o_orderdate AS d FROM orders)
""")(PX.deadline_lenient)

_PV = ", ".join(f"rpad(substr({O.q('')} || {c}, 1, {cut}), {w}, ' ') AS {c}" for c, (cut, w) in PX.PREVIEW_WIDTHS.items())
register("preview", f"""{_MAIL_BASE},
pv AS (
  SELECT ord, source, '' AS emailDate, '' AS alertName, coalesce(text, '') AS opportunityTitle, '' AS url
  FROM mail_keyed ORDER BY ord LIMIT {PREVIEW_ROWS}
)
SELECT {_PV}, CAST(row_number() OVER (ORDER BY ord) AS BIGINT) AS row_pos FROM pv
""")(PX.preview)

register("preview_counts", f"""{_MAIL_BASE}
SELECT CAST(count(DISTINCT doc_id) AS BIGINT) AS emails_found, CAST(count(*) AS BIGINT) AS opportunities,
       CAST(greatest(count(*) - {PREVIEW_ROWS}, 0) AS BIGINT) AS more
FROM mail_keyed
""")(PX.preview_counts)

# --- pages through the DOM facts ---------------------------------------------

register("dom_page_links", f"""{_LINKS}
SELECT page_id, link_pos, href, text AS title FROM links
""")(PP.dom_page_links)

register("dom_devex_listings", f"""{_LINKS},
dec AS (SELECT page_id, link_pos, {O.decode_tracking_sql(O.strip_sql('href'))} AS url, text FROM links),
kept AS (
  SELECT page_id, link_pos, url, {_generic_sql('text', _F.GENERIC_TITLES_DEVEX)} AS title FROM dec
  WHERE NOT regexp_matches(coalesce(url, ''), {O.q(_U.DEVEX_SKIP_PATTERN)})
),
ok AS (
  SELECT *, lower({O.strip_sql('title')}) AS _tkey FROM kept
  WHERE length(title) >= {PP.PAGES_MIN_TITLE_LEN} AND NOT regexp_matches(title, {O.q(_F.GENERIC_LABEL_PATTERN)})
)
SELECT page_id, link_pos, title AS opportunityTitle, url, '' AS donorClient, '' AS countryRegion, '' AS deadline,
       'Tenders & Grants' AS opportunityType, '' AS status, '' AS alertName
FROM (SELECT *, row_number() OVER (PARTITION BY page_id, _tkey ORDER BY link_pos) AS _rn FROM ok) t
WHERE _rn = 1
""")(PP.dom_devex_listings)

# no page says "open" or holds a table, so every listing link of the page counts and its fields are empty
register("dom_da_listings", f"""{_LINKS},
abs_links AS (SELECT page_id, link_pos, {O.strip_sql(O.q(PP.DA_LISTING_BASE) + ' || href')} AS href, text FROM links),
kept AS (
  SELECT page_id, link_pos, href, {_generic_sql('text', _F.GENERIC_TITLES_DA)} AS title FROM abs_links
  WHERE NOT regexp_matches(href, {O.q(_U.DA_SKIP_PATTERN)}) AND regexp_matches(href, {O.q(_U.DA_LISTING_PATTERN)})
),
ok AS (SELECT *, {O.clean_url_sql('href')} AS url FROM kept WHERE title <> '' AND length(title) >= {PP.PAGES_MIN_TITLE_LEN})
SELECT page_id, link_pos, title AS opportunityTitle, t.url, '' AS donorClient, '' AS countryRegion, '' AS deadline, '' AS deadlineISO,
       CASE WHEN regexp_matches(coalesce(html, ''), '(?i)tender alert') THEN 'Tender' WHEN regexp_matches(coalesce(html, ''), '(?i)grant alert') THEN 'Grant'
            ELSE 'Opportunity' END AS opportunityType,
       '' AS status, '' AS alertName
FROM (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY link_pos) AS _rn FROM ok) t JOIN pages USING (page_id)
WHERE _rn = 1
""")(PP.dom_da_listings)

# --- streaming -----------------------------------------------------------------

from bidlake.plans import streams as PS  # noqa: E402

register("stream_dedup_master", """
SELECT event_id, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS _rn FROM events) t
WHERE _rn = 1
""")(PS.stream_dedup_master)

register("stream_dedup_watermark", """
SELECT user_id, event_type, CAST(1 AS BIGINT) AS written FROM events GROUP BY user_id, event_type
""")(PS.stream_dedup_watermark)

register("stream_keyed_first_wins", f"""
SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                           ORDER BY CAST(floor(event_id * {PS.CHUNKS} / ((SELECT max(event_id) FROM events) + 1)) AS BIGINT), ts, event_id) = 1
""")(PS.stream_keyed_first_wins)

register("stream_page_walk", f"""WITH {O.ITEMS_CTE.strip()},
placed AS (
  SELECT *, CAST(organizationCode AS BIGINT) AS agency, row_number() OVER (PARTITION BY organizationCode ORDER BY ord) - 1 AS pos,
         count(*) OVER (PARTITION BY organizationCode) AS n FROM items)
SELECT agency * 1000000000000 + pos AS ord, organizationCode, noticeId FROM placed
WHERE pos < CASE WHEN agency % 2 = 0 THEN CAST(ceil(greatest(n - 250, 0) / {PS.PAGE_SIZE}.0) AS BIGINT) * {PS.PAGE_SIZE}
                 ELSE n // 2 // {PS.PAGE_SIZE} * {PS.PAGE_SIZE} END
""")(PS.stream_page_walk)

register("mail_source_counts", f"""{_MAIL_BASE}
SELECT mailSource AS source, CAST(count(*) AS BIGINT) AS opportunities, CAST(count(DISTINCT doc_id) AS BIGINT) AS messages
FROM mail_keyed GROUP BY mailSource
""")(PM.mail_source_counts)

# --- landed JSON pages (feed A from files) -----------------------------------

_LANDED_PASSED = _NOTICE_BASE.replace(
    "keyed AS (SELECT *,",
    "agency_ord AS (SELECT * FROM (SELECT * REPLACE (CAST(organizationCode AS BIGINT) * 1000000000000 + "
    "row_number() OVER (PARTITION BY organizationCode ORDER BY ord) - 1 AS ord) FROM items) t "
    f"WHERE substr(coalesce(postedDate, ''), 1, 10) >= '{_LB_FROM}' "
    f"AND substr(coalesce(postedDate, ''), 1, 10) <= '{S.STANDIN_RUN_DATE}'),\n"
    "keyed AS (SELECT *,").replace("FROM items),\npassed AS", "FROM agency_ord),\npassed AS")

register("landed_notice_batch", f"""{_LANDED_PASSED},
{O.accepted_cte(None, S.STANDIN_RUN_TS, agency='organizationCode')}
SELECT {_OWNED},
       CAST(row_number() OVER (ORDER BY postedDate DESC, ord) AS BIGINT) AS row_pos
FROM accepted
""")(PN.landed_notice_batch)

# --- pages landed as alert mail (feed B end to end) ------------------------------

from bidlake.functions.normalize import STABLE_ID_PARAM, STABLE_ID_PREFIX  # noqa: E402
from bidlake.functions.text import WORD as _WORD  # noqa: E402


def _mail_pages_sql() -> str:
    alert = O.strip_sql(f"regexp_extract(subject, {O.q('(?i)Business Alert[:' + O.WS + ']+(.+?)$')}, 1)")
    title_ok = (f"length(title) >= 15 AND NOT regexp_matches(title, {O.q(_F.GENERIC_LABEL_PATTERN)}) "
                f"AND NOT (alertName <> '' AND lower({O.strip_sql('title')}) = lower({O.strip_sql('alertName')}))")
    sid = f"regexp_extract(coalesce(url, ''), {O.q('[?&]' + STABLE_ID_PARAM + '=([' + _WORD + '-]+)')}, 1)"
    key = (f"CASE WHEN {sid} <> '' THEN 'devex | {STABLE_ID_PREFIX}' || {sid} "
           f"ELSE 'devex | ' || {O.normalize_text_sql('title')} || ' |  | ' END")
    return f"""{_LINKS},
msg AS (
  SELECT page_id, CAST(page_id AS VARCHAR) AS message_id,
         {O.q(PM.SUBJECT_PREFIX)} || regexp_extract(coalesce(html, ''), {O.q(PM.TITLE_PATTERN)}, 1) AS subject
  FROM pages
),
dec AS (
  SELECT l.page_id, m.message_id, m.subject, {alert} AS alertName, l.link_pos,
         {O.decode_tracking_sql(O.strip_sql('l.href'))} AS url,
         {_generic_sql('l.text', _F.GENERIC_TITLES_DEVEX)} AS title
  FROM links l JOIN msg m ON m.page_id = l.page_id
),
ok AS (
  SELECT *, lower({O.strip_sql('title')}) AS _tkey FROM dec
  WHERE NOT regexp_matches(coalesce(url, ''), {O.q(_U.DEVEX_SKIP_PATTERN)}) AND {title_ok}
),
listed AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, _tkey ORDER BY link_pos) AS _rn FROM ok) t
  WHERE _rn = 1
),
keyed AS (SELECT *, {key} AS duplicateKey FROM listed),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY duplicateKey ORDER BY message_id, link_pos) AS _rk
                 FROM keyed) t
  WHERE _rk = 1
)
SELECT message_id, link_pos, 'Devex' AS source, '{PM.MAIL_RUN_DATE}' AS emailDate, subject AS emailSubject,
       alertName, title AS opportunityTitle, '' AS donorClient, '' AS countryRegion,
       'Tenders & Grants' AS opportunityType, '' AS status, '' AS deadline, '' AS deadlineISO, url,
       {O.language_sql('title')} AS language, '' AS fitScore, '' AS fitLabel, '' AS reviewSummary, duplicateKey,
       {O.q(PM.MAIL_RUN_TS)} AS processedAtUTC, '' AS owner, 'New' AS pipelineStatus
FROM firsts
"""


register("mail_pipeline_pages", _mail_pages_sql())(PM.mail_pipeline_pages)

# --- the stand-in mailbox: listings of both publishers ----------------------------

from bidlake.plans import oracle_mail as OM  # noqa: E402

register("mail_listings_devex", OM.DEVEX_SQL)(PM.mail_listings_devex)
register("mail_listings_da", OM.DA_SQL)(PM.mail_listings_da)
register("mail_pipeline_listings", OM.PIPELINE_SQL)(PM.mail_pipeline_listings)
register("mail_run_summary", OM.SUMMARY_SQL)(PM.mail_run_summary)

# --- stored tables and landings --------------------------------------------------------

register("recheck_stored", REGISTRY["recheck_upsert"][1])(PN.recheck_stored)
register("lookback_landed", f"""WITH {O.ITEMS_CTE.strip()}
SELECT ord, noticeId, postedDate FROM items
WHERE substr(coalesce(postedDate, ''), 1, 10) BETWEEN '{_days_before(S.STANDIN_RUN_DATE, PN.STANDIN_SETTINGS.days_back)}' AND '{S.STANDIN_RUN_DATE}'
""")(PN.lookback_landed)


# --- phrases in whole texts, word by word ---------------------------------------------

def _phrase_sql() -> str:
    """Every place of a text's word list is compared with the phrase's word list."""
    given = ", ".join(f"({O.q(p)})" for p in PM.PHRASES)
    return f"""WITH phrases AS (SELECT col0 AS phrase, regexp_extract_all(lower(col0), '[\\p{{L}}\\p{{N}}]+') AS w FROM (VALUES {given})),
texts AS (SELECT CAST(doc_id AS VARCHAR) AS message_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS l FROM documents
          WHERE doc_id % 13 = 0 OR doc_id % 10 <= 7),
found AS (SELECT phrase, message_id, len(list_filter(range(1, len(l) + 1), lambda i: l[i:i + len(w) - 1] = w)) AS places FROM texts, phrases)
SELECT phrase, message_id, CAST(1 AS INTEGER) AS part_seq, CAST(places AS BIGINT) AS places FROM found WHERE places > 0
"""


register("mail_phrase_places", _phrase_sql())(PM.mail_phrase_places)
