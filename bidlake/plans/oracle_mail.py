"""What the stand-in mailbox must yield, stated in SQL over its tables.

Each listing follows from its order's key (``bidlake.sources.standin_mail``);
no HTML is read here.
"""

from __future__ import annotations

from bidlake.plans import oracle as O
from bidlake.settings import PIPELINE_COLUMNS
from bidlake.sources import standin_mail as M

_ROWS = f"""
l AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st, o_orderdate + INTERVAL 30 DAY AS due, lower(substr(o_orderpriority, 3)) AS prio,
         c_name, c_mktsegment AS seg, n_name, r_name, CASE WHEN n_nationkey % 2 = 0 THEN 'devex' ELSE 'developmentaid' END AS src,
         o_custkey * 1000000 + o_orderkey // {M.BLOCK_KEYS} AS message_seq,
         CASE WHEN n_nationkey % 2 = 0 THEN 'devex-' ELSE 'developmentaid-' END || o_custkey || '-' || o_orderkey // {M.BLOCK_KEYS} AS message_id,
         strftime(DATE '{M.RUN_DATE}' - CAST(o_custkey % 10 AS INTEGER), '%Y-%m-%d') AS emailDate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE o_custkey % 10 <= 7)"""

_DEVEX = f"""
dx_all AS (
  SELECT *, 1 + row_number() OVER (PARTITION BY message_id ORDER BY k) AS link_pos, count(*) OVER (PARTITION BY message_id) AS n,
         CASE k % 8 WHEN 4 THEN 'Lot ' || k WHEN 5 THEN 'Framework agreement for ' || lower(seg) || ' supplies'
                    WHEN 6 THEN seg || ' & transport of goods, lot ' || k WHEN 7 THEN 'Adquisición de equipos para ' || n_name || ', lote ' || k
                    ELSE seg || ' procurement of ' || prio || ' stock, lot ' || k END AS title,
         CASE k % 8 WHEN 1 THEN 'https://www.devex.com/funding/r?report=tender-' || k % 500
                    WHEN 2 THEN 'https://www.devex.com/funding/r?id=' || k || '&report=grant-' || k
                    ELSE 'https://www.devex.com/en/opportunity/lot-' || k END AS url,
         CASE k % 8 WHEN 1 THEN 'tender-' || k % 500 WHEN 2 THEN 'grant-' || k END AS report
  FROM l WHERE src = 'devex'),
dx AS (
  SELECT message_id, message_seq, emailDate, link_pos, title AS opportunityTitle, url, report,
         CASE WHEN k % 5 = 1 THEN '' ELSE n_name END AS donorClient,
         CASE WHEN k % 5 <= 1 THEN '' ELSE r_name || ' (' || n_name || ')' END AS countryRegion,
         CASE WHEN k % 5 <= 1 THEN '' ELSE strftime(due, '%B %-d, %Y') END AS deadline,
         CASE WHEN k % 5 <= 1 THEN '' ELSE strftime(due, '%Y-%m-%d') END AS deadlineISO,
         'Tenders & Grants' AS opportunityType, CASE st WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'CLOSED' ELSE '' END AS status, c_name AS alertName,
         n || ' new reports for your Business Alert: ' || c_name AS emailSubject
  FROM dx_all WHERE k % 8 <> 3 AND length(title) >= 15
  QUALIFY row_number() OVER (PARTITION BY message_id, lower(title) ORDER BY link_pos) = 1)"""

_DA = """
da_all AS (
  SELECT *, CASE WHEN cust % 2 = 0 AND st <> 'F' THEN 1 ELSE 0 END AS section, k % 8 NOT IN (1, 3) AS listing, st = 'O' AND k % 7 <= 1 AS marked,
         count(*) OVER (PARTITION BY message_id) AS n,
         CASE WHEN k % 8 = 4 THEN 'Lote ' || k WHEN k % 3 = 0 THEN 'Servicios de consultoría en ' || lower(seg) || ', lote ' || k
              ELSE lower(seg) || ' equipment for ' || n_name || ' districts, lot ' || k END AS title,
         CASE k % 8 WHEN 2 THEN 'https://www.developmentaid.info/grants/view/' || k || '&id=' || k
                    WHEN 5 THEN 'https://developmentaid.org/tenders/view/c' || cust ELSE 'https://developmentaid.org/tenders/view/lot-' || k END AS url
  FROM l WHERE src = 'developmentaid'),
da_pos AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY section, k) AS link_pos FROM da_all),
da_mail AS (  -- the section that "open" points to: the table under its heading, or the row that is marked first
  SELECT message_id, bool_or(section = 1 AND listing) AS open_table, min(CASE WHEN marked THEN link_pos END) AS first_marked FROM da_pos GROUP BY message_id),
da_scope AS (
  SELECT p.*, CASE WHEN cust % 5 = 3 THEN true
                   WHEN cust % 2 = 0 THEN NOT open_table OR section = 1
                   WHEN first_marked IS NULL THEN true
                   WHEN (SELECT q.listing FROM da_pos q WHERE q.message_id = p.message_id AND q.link_pos = first_marked) THEN link_pos = first_marked
                   ELSE true END AS inside
  FROM da_pos p JOIN da_mail USING (message_id)),
da AS (
  SELECT message_id, message_seq, emailDate, link_pos, title AS opportunityTitle, url, CAST(NULL AS VARCHAR) AS report,
         CASE WHEN k % 10 = 7 THEN '' ELSE n_name END AS donorClient,
         CASE WHEN k % 10 = 7 THEN '' WHEN k % 9 = 0 THEN substr(repeat(n_name || ', ', 30), 1, 100) ELSE r_name END AS countryRegion,
         CASE WHEN k % 10 = 7 OR k % 5 = 0 THEN '' ELSE strftime(due, '%d %b, %Y') END AS deadline,
         CASE WHEN k % 10 = 7 OR k % 5 = 0 THEN '' ELSE strftime(due, '%Y-%m-%d') END AS deadlineISO,
         CASE cust % 3 WHEN 0 THEN 'Tender' WHEN 1 THEN 'Grant' ELSE 'Opportunity' END AS opportunityType,
         CASE WHEN marked THEN 'Open' ELSE '' END AS status, lower(seg) || ' list' AS alertName,
         n || ' Funding opportunities from DevelopmentAid: ' || lower(seg) || ' list' AS emailSubject
  FROM da_scope WHERE inside AND listing AND length(title) >= 15
  QUALIFY row_number() OVER (PARTITION BY message_id, url ORDER BY link_pos) = 1)"""

_FIELDS = "message_id, CAST(link_pos AS BIGINT) AS link_pos, opportunityTitle, url, donorClient, countryRegion, deadline"

DEVEX_SQL = f"WITH {_ROWS.strip()},{_DEVEX}\nSELECT {_FIELDS}, opportunityType, status, alertName FROM dx"
DA_SQL = f"WITH {_ROWS.strip()},{_DA}\nSELECT {_FIELDS}, deadlineISO, opportunityType, status, alertName FROM da"

_KEY = (f"CASE WHEN report IS NOT NULL THEN 'devex | devex-report:' || report ELSE lower(source) || ' | ' || {O.normalize_text_sql('opportunityTitle')} "
        f"|| ' | ' || {O.normalize_text_sql('donorClient')} || ' | ' || {O.normalize_text_sql('countryRegion')} END")
_CONSTANT = {"fitScore": "''", "fitLabel": "''", "reviewSummary": "''", "owner": "''", "pipelineStatus": "'New'", "processedAtUTC": O.q(M.RUN_TS),
             "language": O.language_sql("opportunityTitle")}

_KEYED = f"""
both_sources AS (SELECT 0 AS source_seq, 'Devex' AS source, * FROM dx UNION ALL SELECT 1, 'DevelopmentAid', * FROM da),
keyed AS (SELECT *, {_KEY} AS duplicateKey FROM both_sources),
firsts AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY duplicateKey ORDER BY source_seq, message_seq, message_id, link_pos) = 1)"""

PIPELINE_SQL = f"""WITH {_ROWS.strip()},{_DEVEX},{_DA},{_KEYED}
SELECT message_id, CAST(link_pos AS BIGINT) AS link_pos, {', '.join(f"{_CONSTANT.get(c, c)} AS {c}" for c in PIPELINE_COLUMNS)} FROM firsts
"""

SUMMARY_SQL = f"""WITH {_ROWS.strip()},{_DEVEX},{_DA},{_KEYED}
SELECT (SELECT count(*) FROM firsts) AS appended, (SELECT count(*) FROM keyed) - (SELECT count(*) FROM firsts) AS skipped,
       (SELECT count(*) FROM keyed) AS total_processed
"""
