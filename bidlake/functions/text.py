"""Scalar column functions (``Column -> Column``), all JVM-native.

Every function here is a composition of built-in expressions, so it stays
inside whole-stage codegen and can be pushed/folded by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlake.settings import OPP_URL_PREFIX, OPP_URL_SUFFIX

# Characters Python's ``str.strip()`` / ``\s`` treat as whitespace, written
# with escapes both Java regex and RE2 accept (``\x{...}``).  Spark's ``trim``
# removes only the space character, so "strip" needs this class.
WS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# The same characters as a literal set, for character-set trimming.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Word characters in the Unicode sense (letters, numbers, underscore).
WORD = r"\p{L}\p{N}_"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Python ``strip()``: remove leading/trailing Unicode whitespace.

    A character-set trim (no regex), so it stays cheap inside codegen.
    """
    return F.btrim(col_(c), F.lit(WS_CHARS))


def blank(c: Column | str) -> Column:
    """``str(x or '').strip()``: NULL-safe stripped string."""
    return trim_ws(F.coalesce(col_(c), F.lit("")))


def collapse_ws(c: Column | str) -> Column:
    """Collapse whitespace runs to one space and strip."""
    return trim_ws(F.regexp_replace(col_(c), f"[{WS}]+", " "))


def normalize_date(c: Column | str) -> Column:
    """First ten characters of whatever arrived (not parsed); NULL -> ''."""
    return F.substring(F.coalesce(col_(c), F.lit("")), 1, 10)


def mmddyyyy(c: Column | str) -> Column:
    """A date rendered ``MM/dd/yyyy``."""
    return F.date_format(col_(c), "MM/dd/yyyy")


def opp_url(notice_id: Column | str) -> Column:
    """Public page of a notice; blank id gives ''."""
    nid = F.coalesce(col_(notice_id), F.lit(""))
    return F.when(nid != "", F.concat(F.lit(OPP_URL_PREFIX), nid, F.lit(OPP_URL_SUFFIX))).otherwise(F.lit(""))


def agency_label(code: Column | str) -> Column:
    """Queried agency code, or ``ALL`` for an unrestricted pass."""
    return F.coalesce(F.nullif(col_(code), F.lit("")), F.lit("ALL"))


def iso_date_or_fallback(posted: Column | str, run_date: str, days: int = 365) -> Column:
    """Strict ``yyyy-M-d`` parse of the first 10 chars, else run_date - days.

    ``try_to_date`` keeps ANSI mode from raising on bad input.
    """
    parsed = F.try_to_date(F.substring(F.coalesce(col_(posted), F.lit("")), 1, 10), "yyyy-M-d")
    return F.coalesce(parsed, F.date_sub(F.to_date(F.lit(run_date)), days))


def alert_name(subject: Column | str, marker: str) -> Column:
    """Text after ``<marker>`` plus ``:``/spaces up to the end, stripped; else ''."""
    pattern = f"(?i){marker}[:{WS}]+(.+?)$"
    return trim_ws(F.coalesce(F.regexp_extract(col_(subject), pattern, 1), F.lit("")))


def opportunity_type(html: Column | str) -> Column:
    """Alert kind from the body text: Tender, Grant, or Opportunity."""
    h = F.coalesce(col_(html), F.lit(""))
    return (
        F.when(h.rlike("(?i)tender alert"), F.lit("Tender"))
        .when(h.rlike("(?i)grant alert"), F.lit("Grant"))
        .otherwise(F.lit("Opportunity"))
    )


def second_cell(cells: Column | str) -> Column:
    """Text of the second cell of a row, else ''."""
    return F.coalesce(F.try_element_at(col_(cells), F.lit(2)), F.lit(""))


def label_key(cell: Column | str) -> Column:
    """Label cell -> key: strip, drop trailing ':', strip, lower."""
    stripped = trim_ws(F.coalesce(col_(cell), F.lit("")))
    return F.lower(trim_ws(F.regexp_replace(stripped, r":+\z", "")))


def first_present(m: Column | str, keys: tuple[str, ...], width: int = 100) -> Column:
    """First synonym present in the map (even if its value is blank), cut to ``width``."""
    lookups = [F.try_element_at(col_(m), F.lit(k)) for k in keys]
    return F.substring(F.coalesce(*lookups, F.lit("")), 1, width)


def contains_word(c: Column | str, word: str) -> Column:
    """Case-insensitive whole-word test with Unicode word boundaries."""
    return F.coalesce(col_(c), F.lit("")).rlike(f"(?iu)(^|[^{WORD}]){word}([^{WORD}]|$)")


def fixed_width(c: Column | str, cut: int, width: int) -> Column:
    """Preview cell: first ``cut`` characters, right-padded with spaces to ``width``."""
    return F.rpad(F.substring(F.coalesce(col_(c), F.lit("")), 1, cut), width, " ")
