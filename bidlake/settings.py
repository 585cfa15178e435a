"""Job parameters and the fixed values the results depend on.

The lists below must equal the configured values of the original
application for identical filtering; they are data, kept together and in
their configured order.  At run time they become tiny literal sets or
broadcast tables (a few dozen rows: a proven size bound).
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
# Two-digit industry sectors whose codes are always excluded.
EXCLUDED_SECTOR_PREFIXES: tuple[str, ...] = (
    "11", "21", "22", "23", "31", "32", "33", "42", "44",
    "45", "48", "49", "52", "53", "55", "62", "71", "72",
)

# Exact industry codes excluded (exact match only: "56211" does not exclude "562112").
EXCLUDED_CODES: tuple[str, ...] = (
    "561499", "532111", "562111", "561710", "562991", "523940", "532420",
    "561790", "532490", "524210", "531120", "524298", "561990", "561421",
    "532289", "56211", "56151", "561720", "56172", "517212", "562213",
    "517410", "523999", "524126", "541810", "561612", "541380", "524292",
    "561730", "562998", "517112", "517122", "51712", "541519", "517111",
    "541310", "541214", "524114", "54193", "541930", "524113", "561210",
    "541110", "561621", "561920", "561599", "561510",
)

# Top-level departments excluded (first "."-segment, exact, case-sensitive).
EXCLUDED_DEPARTMENTS: tuple[str, ...] = (
    "DEPT OF DEFENSE",
    "VETERANS AFFAIRS, DEPARTMENT OF",
)

# Columns owned by the notice feed, in table order.
NOTICE_COLUMNS: tuple[str, ...] = (
    "noticeId", "title", "solicitationNumber", "postedDate", "type",
    "setAside", "naicsCode", "fullParentPathName", "fullParentPathCode",
    "agencyCodeQueried", "apiPulledAtUTC", "oppUrl", "deadline",
)

# Run-log columns, in table order.
RUN_LOG_COLUMNS: tuple[str, ...] = (
    "runAtUTC", "postedFrom", "postedTo", "agencies", "keyword", "newRows", "notes",
)

# Columns compared by the re-check and the review columns it clears.
DIFF_FIELDS: tuple[str, ...] = ("title", "naicsCode", "type", "deadline")
RESCORE_FIELDS: tuple[str, ...] = ("fitLabel", "reviewSummary", "deadlineNote", "reviewedAtUTC")

# Columns of the e-mail opportunity table, in table order.
PIPELINE_COLUMNS: tuple[str, ...] = (
    "source", "emailDate", "emailSubject", "alertName", "opportunityTitle",
    "donorClient", "countryRegion", "opportunityType", "status", "deadline",
    "deadlineISO", "url", "language", "fitScore", "fitLabel", "reviewSummary",
    "duplicateKey", "processedAtUTC", "owner", "pipelineStatus",
)

# Public notice page URL: prefix + id + suffix.
OPP_URL_PREFIX = "https://sam.gov/opp/"
OPP_URL_SUFFIX = "/view"

# Defaults of the scheduled runs.
DEFAULT_DAYS_BACK = 7
DEFAULT_PAGE_SIZE = 200
DEFAULT_MIN_TITLE_LEN = 15
PREVIEW_ROWS = 30
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class JobSettings:
    """Parameters of one notice / e-mail run (the YAML settings as a value)."""

    agency_codes: tuple[str, ...] = ()
    days_back: int = DEFAULT_DAYS_BACK
    page_size: int = DEFAULT_PAGE_SIZE
    max_records: int | None = None
    excluded_codes: tuple[str, ...] = EXCLUDED_CODES
    excluded_prefixes: tuple[str, ...] = EXCLUDED_SECTOR_PREFIXES
    excluded_departments: tuple[str, ...] = EXCLUDED_DEPARTMENTS
    keyword: str | None = None
    min_title_len: int = DEFAULT_MIN_TITLE_LEN
