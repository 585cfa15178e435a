"""Row filters of both feeds (F1..F16) as plain Catalyst predicates.

The code rules are literal-set tests: ``substring(code, 1, k) NOT IN
(prefixes of length k)`` and ``code NOT IN (codes)`` (both compile to a
hash-set ``InSet``).  A chain of 18 ``NOT startswith`` tests over the same
stripped expression repeats it 18 times and measured ~3x slower.
Blank/NULL keeps are explicit OR branches: a NULL comparison would
silently drop the row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.functions import text as T
from bidlake.functions import urls as U


def non_blank_id(id_col: str = "noticeId") -> Column:
    """id present after strip."""
    return T.blank(id_col) != ""


def sector_allowed(code: Column | str, prefixes: tuple[str, ...]) -> Column:
    """code does not start with any excluded sector prefix.

    ``startswith(c, p)`` equals ``substring(c, 1, len(p)) == p``, so prefixes
    are grouped by length and each group is one set-membership test.
    """
    c = T.col_(code)
    by_len: dict[int, list[str]] = {}
    for p in prefixes:
        by_len.setdefault(len(p), []).append(p)
    tests = [~F.substring(c, 1, n).isin(group) for n, group in sorted(by_len.items())]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def code_allowed(code: Column | str, prefixes: tuple[str, ...], excluded: tuple[str, ...]) -> Column:
    """F2 + F3 + F4: blank code keeps; else neither an excluded sector nor an exact code."""
    c = T.blank(code)
    return (c == "") | (sector_allowed(c, prefixes) & ~c.isin(list(excluded)))


def top_department(path: Column | str) -> Column:
    """First ``.``-segment of the organisation path, stripped."""
    return T.trim_ws(F.substring_index(F.coalesce(T.col_(path), F.lit("")), ".", 1))


def department_allowed(path: Column | str, excluded: tuple[str, ...]) -> Column:
    """blank path keeps; else its top department is not excluded (exact, case-sensitive)."""
    if not excluded:
        return F.lit(True)
    p = F.coalesce(T.col_(path), F.lit(""))
    return (p == "") | ~top_department(p).isin(list(excluded))


def filter_notices(df: DataFrame, excluded_prefixes, excluded_codes, excluded_departments,
                   id_col: str = "noticeId", code_col: str = "naicsCode",
                   path_col: str = "fullParentPathName") -> DataFrame:
    """F1..F5 in one conjunctive filter (runs before the first-wins dedup)."""
    return df.where(
        non_blank_id(id_col)
        & code_allowed(code_col, excluded_prefixes, excluded_codes)
        & department_allowed(path_col, excluded_departments)
    )


def filter_departments_by_table(df: DataFrame, departments: DataFrame, path_col: str = "fullParentPathName") -> DataFrame:
    """F5 as a join: anti-join the top department against an exclusion table.

    The table is the caller's; it is stored, and its size decides whether
    Spark broadcasts it.
    """
    from bidlake.session import stored

    keyed = df.withColumn("_top", top_department(path_col))
    excluded = stored(departments.select(F.col(departments.columns[0]).alias("_top")).distinct().withColumn("_excluded", F.lit(True)))
    flagged = keyed.join(excluded, "_top", "left")
    keep = (F.coalesce(F.col(path_col), F.lit("")) == "") | F.col("_excluded").isNull()
    return flagged.where(keep).drop("_top", "_excluded")


def posted_between(posted: Column | str, start: str, end: str) -> Column:
    """``yyyy-MM-dd`` string (or date) inside [start, end]."""
    p = F.substring(F.coalesce(T.col_(posted).cast("string"), F.lit("")), 1, 10)
    return (p >= F.lit(start)) & (p <= F.lit(end))


def lookback(posted: Column | str, run_date: str, days_back: int) -> Column:
    """S3: posted within ``days_back`` days up to the run date."""
    start = F.date_format(F.date_sub(F.to_date(F.lit(run_date)), days_back), "yyyy-MM-dd")
    p = F.substring(F.coalesce(T.col_(posted).cast("string"), F.lit("")), 1, 10)
    return (p >= start) & (p <= F.lit(run_date))


def source_predicates(df: DataFrame, posted_from: str, posted_to: str, organization_code: str | None = None,
                      keyword: str | None = None, notice_id: str | None = None,
                      posted_col: str = "postedDate", org_col: str = "organizationCode",
                      title_col: str = "title", id_col: str = "noticeId") -> DataFrame:
    """The optional search predicates of a notice query.

    Organisation: equality; keyword: case-insensitive substring of the title;
    id: equality after strip.  All are ordinary predicates, so they reach the
    scan as pushed filters where the layout allows.
    """
    cond = posted_between(posted_col, posted_from, posted_to)
    if organization_code:
        cond = cond & (F.col(org_col) == F.lit(organization_code))
    if keyword:
        cond = cond & F.lower(F.coalesce(F.col(title_col), F.lit(""))).contains(keyword.lower())
    if notice_id:
        cond = cond & (T.blank(id_col) == F.lit(notice_id.strip()))
    return df.where(cond)


def high_priority(fit_col: str = "fitLabel", id_col: str = "noticeId") -> Column:
    """``strip(lower(fitLabel)) == 'high'`` with a present id."""
    return (F.lower(T.blank(fit_col)) == "high") & (F.coalesce(F.col(id_col), F.lit("")) != "")


def title_ok(title: Column | str, min_len: int, alert: Column | str | None = None) -> Column:
    """F9 + F10 + F11: long enough, not a generic label, not the alert's own name."""
    t = F.coalesce(T.col_(title), F.lit(""))
    ok = (F.length(t) >= min_len) & ~t.rlike(GENERIC_LABEL_PATTERN)
    if alert is not None:
        a = F.coalesce(T.col_(alert), F.lit(""))
        ok = ok & ~((a != "") & (F.lower(T.trim_ws(t)) == F.lower(T.trim_ws(a))))
    return ok


# --- fixed values -----------------------------------------------------------
# Link texts that are never a listing title (full match, any case).
GENERIC_LABEL_PATTERN = (
    r"(?i)^(read more|view|apply|details|more|learn more|click here|see all|"
    r"manage your alert|create new alert|funding search|here|www\.devex\.com)$"
)
# Link texts blanked before any rule runs (exact, lower-cased).
GENERIC_TITLES_DEVEX: tuple[str, ...] = (
    "read more", "view", "apply", "details", "more", "learn more", "click here",
)
GENERIC_TITLES_DA: tuple[str, ...] = (
    "read more", "view", "apply", "details", "more", "learn more", "click here", "ver más", "ver",
)
# ---------------------------------------------------------------------------


def link_title(raw_text: Column | str, generic: tuple[str, ...]) -> Column:
    """Whitespace-collapsed anchor text; generic labels become ''."""
    t = T.collapse_ws(F.coalesce(T.col_(raw_text), F.lit("")))
    return F.when(F.lower(t).isin(list(generic)), F.lit("")).otherwise(t)


def devex_link_ok(decoded_url: Column | str) -> Column:
    """F6."""
    return ~U.devex_skip(decoded_url)


def da_link_ok(href: Column | str) -> Column:
    """F7 + F8."""
    return ~U.da_skip(href) & U.da_listing(href)

