"""SQL building blocks for the independent oracle (DuckDB dialect).

The stand-in views of ``bidlake.sources.standins`` are rebuilt here in
plain SQL from the same fixed values, so every registered query has a
second, engine-independent formulation over the same parquet tables.
"""

from __future__ import annotations

from bidlake.functions.text import WS, WS_CHARS
from bidlake.settings import EXCLUDED_CODES, EXCLUDED_SECTOR_PREFIXES
from bidlake.sources.standins import (
    COPY_STRIDE,
    MASTER_PULLED_TS,
    STANDIN_CODES,
    STANDIN_DEPARTMENTS,
)


def q(s: str | None) -> str:
    """SQL string literal."""
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def strip_sql(expr: str) -> str:
    """Python ``strip()`` in SQL."""
    return f"trim({expr}, {q(WS_CHARS)})"


def blank_sql(expr: str) -> str:
    return strip_sql(f"coalesce({expr}, '')")


def code_ok_sql(code: str) -> str:
    starts = " OR ".join(f"starts_with({code}, {q(p)})" for p in EXCLUDED_SECTOR_PREFIXES)
    return f"({code} = '' OR (NOT ({starts}) AND {code} NOT IN {in_list(EXCLUDED_CODES)}))"


def dept_ok_sql(path: str, departments=STANDIN_DEPARTMENTS) -> str:
    top = strip_sql(f"split_part(coalesce({path}, ''), '.', 1)")
    return f"(coalesce({path}, '') = '' OR {top} NOT IN {in_list(departments)})"


CODES_VALUES = ", ".join(f"({i}, {q(c)})" for i, c in enumerate(STANDIN_CODES))

# Raw notice items (both copies) and the helpers the stand-ins carry.
ITEMS_CTE = f"""
codes(idx, code) AS (VALUES {CODES_VALUES}),
facts AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
         c.c_mktsegment, n.n_name, n.n_nationkey, n.n_regionkey, r.r_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
copies AS (
  SELECT 0 AS copy_no, * FROM facts
  UNION ALL
  SELECT 1 AS copy_no, * FROM facts WHERE o_orderstatus = 'O'
),
items AS (
  SELECT CAST(copy_no AS BIGINT) * {COPY_STRIDE} + o_orderkey AS ord,
         o_orderkey,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN ''
              WHEN o_orderpriority = '3-MEDIUM' THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
              ELSE CAST(o_orderkey AS VARCHAR) END AS noticeId,
         c_mktsegment || ' ' || o_orderpriority AS title,
         'SOL-' || CAST(o_custkey AS VARCHAR) AS solicitationNumber,
         CAST(o_orderdate AS VARCHAR) AS postedDate,
         CAST(o_orderdate + INTERVAL 30 DAY AS VARCHAR) AS responseDeadLine,
         o_orderstatus AS type,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'SBA' END AS setAside,
         codes.code AS naicsCode,
         r_name || '.' || n_name AS fullParentPathName,
         CAST(n_regionkey AS VARCHAR) || '.' || CAST(n_nationkey AS VARCHAR) AS fullParentPathCode,
         CAST(n_regionkey AS VARCHAR) AS organizationCode,
         o_orderstatus AS _status,
         o_orderpriority AS _priority,
         o_orderdate AS _orderdate
  FROM copies LEFT JOIN codes ON codes.idx = (o_orderkey + 7 * copy_no) % 41
)"""


def project_sql(src: str, agency: str, pulled_at: str, extra: str = "") -> str:
    """P1 in SQL over a raw-item relation."""
    nid = blank_sql("noticeId")
    return f"""SELECT {nid} AS noticeId, title, solicitationNumber,
       substr(coalesce(postedDate, ''), 1, 10) AS postedDate, type, setAside,
       {blank_sql('naicsCode')} AS naicsCode, fullParentPathName, fullParentPathCode,
       coalesce(nullif({agency}, ''), 'ALL') AS agencyCodeQueried,
       {q(pulled_at)} AS apiPulledAtUTC,
       CASE WHEN {nid} <> '' THEN 'https://sam.gov/opp/' || {nid} || '/view' ELSE '' END AS oppUrl,
       substr(coalesce(responseDeadLine, ''), 1, 10) AS deadline{extra}
FROM {src}"""


MASTER_CTE = f"""
master AS (
  SELECT *, CASE WHEN _priority = '1-URGENT' THEN ' High ' WHEN _priority = '2-HIGH' THEN 'high' ELSE '' END AS fitLabel,
         'reviewed' AS reviewSummary, '' AS deadlineNote, '' AS deadlineISO,
         {q(MASTER_PULLED_TS)} AS reviewedAtUTC, '' AS emailedAtUTC
  FROM ({project_sql("items WHERE ord < " + str(COPY_STRIDE) + " AND _status = 'F'", "''", MASTER_PULLED_TS, ", _priority")}) m
)"""

PASSED_CTE = f"""
keyed AS (SELECT *, {blank_sql('noticeId')} AS _nid, {blank_sql('naicsCode')} AS _code FROM items),
passed AS (
  SELECT * FROM keyed
  WHERE _nid <> '' AND {code_ok_sql('_code')} AND {dept_ok_sql('fullParentPathName')}
),
firsts AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY _nid ORDER BY ord) AS _rn FROM passed) t
  WHERE _rn = 1
),
master_keys AS (SELECT DISTINCT {blank_sql('noticeId')} AS _nid FROM master WHERE {blank_sql('noticeId')} <> ''),
fresh_rows AS (SELECT * FROM firsts WHERE _nid NOT IN (SELECT _nid FROM master_keys))"""


def accepted_cte(cap: int | None, pulled_at: str, agency: str = "''") -> str:
    limit = f" ORDER BY ord LIMIT {cap}" if cap is not None else ""
    capped = f"capped AS (SELECT * FROM fresh_rows{limit})"
    return f"""{capped},
accepted AS ({project_sql('capped', agency, pulled_at, ', ord, organizationCode')})"""


FRESH_CTE = f"""
fresh_base AS (
  SELECT ord, noticeId,
         CASE WHEN _priority = '2-HIGH' THEN title || ' (amended)' ELSE title END AS title,
         CASE WHEN _priority = '3-MEDIUM' THEN CAST(_orderdate - INTERVAL 1 DAY AS VARCHAR) ELSE postedDate END AS postedDate,
         CASE WHEN _priority = '1-URGENT' THEN CAST(_orderdate + INTERVAL 44 DAY AS VARCHAR) ELSE responseDeadLine END AS responseDeadLine,
         type, naicsCode, _status, _priority
  FROM items WHERE ord < {COPY_STRIDE} AND _priority <> '4-NOT SPECIFIED'
),
fresh_all AS (
  SELECT ord, noticeId, title, postedDate, responseDeadLine, type, naicsCode FROM fresh_base
  UNION ALL
  SELECT ord + {COPY_STRIDE}, noticeId, title, postedDate, responseDeadLine, 'X', naicsCode
  FROM fresh_base WHERE _status = 'F' AND _priority = '1-URGENT'
),
fresh_p AS (
  SELECT {blank_sql('noticeId')} AS noticeId, coalesce(title, '') AS title, {blank_sql('naicsCode')} AS naicsCode,
         coalesce(type, '') AS type, substr(coalesce(responseDeadLine, ''), 1, 10) AS deadline,
         TRY_CAST(substr(coalesce(postedDate, ''), 1, 10) AS DATE) AS _fposted, ord
  FROM fresh_all
)"""


def recheck_cte(run_date: str) -> str:
    hi = f"lower({blank_sql('fitLabel')}) = 'high' AND coalesce(noticeId, '') <> ''"
    chg = {c: f"(fresh_ord IS NOT NULL AND coalesce({c}, '') <> fresh_{c})"
           for c in ("title", "naicsCode", "type", "deadline")}
    return f"""
high AS (SELECT *, coalesce(postedDate, '') AS _mposted FROM master WHERE {hi}),
rkeys AS (
  SELECT noticeId, _mposted,
         coalesce(TRY_CAST(strptime(substr(_mposted, 1, 10), '%Y-%m-%d') AS DATE), DATE '{run_date}' - 365) AS _from
  FROM (SELECT DISTINCT noticeId, _mposted FROM high) d
),
cand AS (
  SELECT k.noticeId, k._mposted, f.ord AS fresh_ord, f.title AS fresh_title, f.naicsCode AS fresh_naicsCode,
         f.type AS fresh_type, f.deadline AS fresh_deadline,
         row_number() OVER (PARTITION BY k.noticeId, k._mposted ORDER BY f.ord) AS _rn
  FROM rkeys k JOIN fresh_p f ON f.noticeId = k.noticeId
  WHERE f._fposted <= DATE '{run_date}' AND f._fposted >= k._from
),
matched AS (SELECT * EXCLUDE (_rn) FROM cand WHERE _rn = 1),
diffed AS (
  SELECT h.*, m.fresh_ord, m.fresh_title, m.fresh_naicsCode, m.fresh_type, m.fresh_deadline,
         {chg['title']} AS _chg_title, {chg['naicsCode']} AS _chg_naicsCode,
         {chg['type']} AS _chg_type, {chg['deadline']} AS _chg_deadline
  FROM high h LEFT JOIN matched m ON m.noticeId = h.noticeId AND m._mposted = h._mposted
),
diffed2 AS (
  SELECT *, concat_ws(',', CASE WHEN _chg_title THEN 'title' END, CASE WHEN _chg_naicsCode THEN 'naicsCode' END,
                           CASE WHEN _chg_type THEN 'type' END, CASE WHEN _chg_deadline THEN 'deadline' END) AS changed_fields,
         (_chg_title OR _chg_naicsCode OR _chg_type OR _chg_deadline) AS changed
  FROM diffed
)"""


def nfkd_marks_sql(expr: str) -> str:
    """NFKD followed by mark removal for canonically accented letters:
    every accented character becomes its base letter plus a space (the
    space stands for the combining mark that normalisation turns into one)."""
    chars = f"string_split({expr}, '')"
    fix = "lambda ch: CASE WHEN strip_accents(ch) <> ch THEN strip_accents(ch) || ' ' ELSE ch END"
    return f"CASE WHEN regexp_full_match({expr}, '[\\x00-\\x7F]*') THEN {expr} " \
           f"ELSE array_to_string(list_transform({chars}, {fix}), '') END"


def normalize_text_sql(expr: str) -> str:
    """X5 in SQL: NFKD, lower, non-word to space, collapse, strip."""
    from bidlake.functions.text import WORD

    s = f"coalesce({expr}, '')"
    spaced = f"regexp_replace(lower({nfkd_marks_sql(s)}), '[^{WORD}{WS}]', ' ', 'g')"
    return f"trim(regexp_replace({spaced}, '[{WS}]+', ' ', 'g'), ' ')"


def language_sql(expr: str) -> str:
    from bidlake.functions.normalize import SPANISH_MARKERS
    from bidlake.functions.text import WORD

    pat = f"(?i)(^|[^{WORD}])(" + "|".join(SPANISH_MARKERS) + f")([^{WORD}]|$)"
    s = f"coalesce({expr}, '')"
    return f"CASE WHEN {s} = '' THEN '' WHEN regexp_matches({s}, {q(pat)}) THEN 'Spanish' ELSE 'English' END"


def mail_opps_cte() -> str:
    src = "CASE WHEN lang IN ('en', 'de') THEN 'devex' ELSE 'developmentaid' END"
    label = "CASE WHEN lang IN ('en', 'de') THEN 'Devex' ELSE 'DevelopmentAid' END"
    key = (f"lower({label}) || ' | ' || {normalize_text_sql('text')} || ' | ' || "
           f"{normalize_text_sql('lang')} || ' | ' || {normalize_text_sql('source')}")
    return f"""
opps AS (
  SELECT doc_id AS ord, doc_id, text, lang, source FROM documents
  UNION ALL
  SELECT {COPY_STRIDE} + doc_id AS ord, doc_id, text, lang, source FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels)
),
mail_keyed AS (
  SELECT ord, doc_id, {label} AS source, {src} AS mailSource, text, lang, source AS countryRegion,
         {key} AS duplicateKey
  FROM opps
),
mail_master AS (
  SELECT DISTINCT {key} AS duplicateKey FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
),
mail_firsts AS (SELECT duplicateKey, min(ord) AS ord, count(*) AS copies FROM mail_keyed GROUP BY 1),
mail_class AS (
  SELECT k.*, CASE WHEN k.duplicateKey IN (SELECT duplicateKey FROM mail_master) THEN 'dup_master'
                   WHEN k.ord IN (SELECT ord FROM mail_firsts) THEN 'new' ELSE 'dup_batch' END AS appendStatus
  FROM mail_keyed k
)"""


def clean_url_sql(expr: str) -> str:
    from bidlake.functions.urls import TRACKING_PARAM_PATTERN

    dropped = f"regexp_replace(coalesce({expr}, ''), {q(TRACKING_PARAM_PATTERN)}, '', 'g')"
    return f"regexp_replace({dropped}, '[?&]+$', '')"


def decode_tracking_sql(expr: str) -> str:
    from bidlake.functions.urls import TRACKER_PATTERN

    m = f"regexp_extract(coalesce({expr}, ''), {q(TRACKER_PATTERN)}, 1)"
    return f"CASE WHEN {m} <> '' THEN url_decode({m}) ELSE {expr} END"


def unescape_sql(expr: str) -> str:
    from bidlake.operators.links import ENTITIES

    for ent, ch in ENTITIES:
        expr = f"replace({expr}, {q(ent)}, {q(ch)})"
    return expr


def collapse_sql(expr: str) -> str:
    return strip_sql(f"regexp_replace({expr}, '[{WS}]+', ' ', 'g')")


def anchors_cte() -> str:
    # the rule restated for the pages at hand, whose links are all in double quotes
    anchor = r"""(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>"""
    text = collapse_sql(unescape_sql("regexp_replace(inner_html, '<[^>]*>', ' ', 'g')"))
    return f"""
anc AS (
  SELECT page_id,
         regexp_extract_all(coalesce(html, ''), {q(anchor)}, 1) AS hrefs,
         regexp_extract_all(coalesce(html, ''), {q(anchor)}, 2) AS inners
  FROM pages
),
raw_links AS (
  SELECT page_id, unnest(range(len(hrefs))) AS _i, unnest(hrefs) AS href, unnest(inners) AS inner_html FROM anc
),
links AS (SELECT page_id, CAST(_i AS BIGINT) AS link_pos, href, {text} AS text FROM raw_links)"""
